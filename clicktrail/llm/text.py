"""Words and shingles of whole Arrow text columns as numpy arrays of 64-bit hashes.

All bytes of a column are handled at once: a byte table says which bytes belong
to words (upper case folded), prefix sums of a polynomial give the hash of any
byte range. Two words get the same hash when their bytes are equal after folding
A-Z; different words share one with chance 2**-64 or so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 21  # text handled at a time; one longer document is a chunk of its own

_RANDOM = np.random.default_rng(20240131)
_CODES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CODES[65:91] = _CODES[97:123]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def word_table(other: bytes | None = None) -> np.ndarray:
    """Which bytes are part of words: all but ``other``, or ASCII letters, digits and non-ASCII bytes."""
    table = np.ones(256, bool)
    if other is None:
        table[:128] = False
        for first, last in (b"09", b"az", b"AZ"):
            table[first : last + 1] = True
    else:
        table[list(other)] = False
    return table


NOT_SPACE = word_table(b" \t\n\x0b\x0c\r")
ALPHANUMERIC = word_table()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, or one row each."""
    ends = np.cumsum(np.asarray(pc.binary_length(texts).fill_null(0), dtype=np.int64))
    low, done = 0, 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield low, high
        low, done = high, int(ends[high - 1])


@dataclass
class Words:
    """Words of several documents: byte range, document number and, for each document, its first word."""

    sums: np.ndarray
    inverse: np.ndarray
    start: np.ndarray
    end: np.ndarray
    document: np.ndarray
    first: np.ndarray  # one more than documents

    def hashes(self, longest: int | None = None) -> np.ndarray:
        """Hashes of the words, or of their first ``longest`` bytes."""
        end = self.end if longest is None else np.minimum(self.end, self.start + longest)
        return mixed((self.sums[end] - self.sums[self.start]) * self.inverse[self.start])


def words(texts: pa.Array, table: np.ndarray) -> Words:
    """The words of a string column; null counts as empty."""
    texts = pa.concat_arrays([texts.cast(pa.large_string()).fill_null("")])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    size = len(data)
    inside = np.zeros(size + 2, bool)
    inside[1:-1] = table[data]
    new = np.zeros(size + 1, bool)
    new[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | new))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | new))
    powers = np.full(size + 1, _BASE, np.uint64)
    inverse = np.full(size + 1, _INVERSE, np.uint64)
    powers[0] = inverse[0] = 1
    np.cumprod(powers, out=powers)
    np.cumprod(inverse, out=inverse)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_CODES[data] * powers[:size], out=sums[1:])
    document = np.searchsorted(offsets, start, side="right") - 1
    first = np.searchsorted(document, np.arange(len(texts) + 1))
    return Words(sums, inverse, start, end, document, first)


def shingle_sets(texts: pa.Array, size: int, table: np.ndarray = NOT_SPACE) -> list[np.ndarray]:
    """Each text's set of ``size``-word shingles as sorted distinct hashes.

    A text with fewer words has its whole sequence as the one element; without
    words the set is empty.
    """
    found = words(texts, table)
    one = found.hashes()
    n = len(one)
    rolled = np.zeros(n, np.uint64)
    for i in range(size):
        rolled[: n - i] += np.roll(one, -i)[: n - i] * np.uint64(pow(_BASE, i + 1, 2**64))
    rolled = mixed(rolled)
    sets = []
    for low, high in zip(found.first[:-1], found.first[1:]):
        if high - low >= size:
            sets.append(np.unique(rolled[low : high - size + 1]))
        elif high > low:
            total = int(high - low) * 0x632BE59BD9B4E019
            for i, word in enumerate(one[low:high]):
                total += int(word) * pow(_BASE, i + 1, 2**64)
            sets.append(mixed(np.array([total % 2**64], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
