"""Byte-level BPE ids of whole texts by merge replay, and the bytes behind ids.

The distinct words of many texts are merged together. An inverted index holds, for
each merge that some pair of neighbouring tokens allows, the places of such pairs;
merges are replayed in rank order, and each looks only at its places and at the
neighbours they touch. Every word is merged once, however often it occurs.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.text import chunks

TEXT_BYTES = 1 << 23  # text whose words are merged together; a longer text is taken alone
KNOWN_WORDS = 150_000  # merged words of up to KNOWN_BYTES bytes that a task remembers
KNOWN_BYTES = 64


@dataclass(frozen=True)
class Vocabulary:
    """Bytes of every id, the id of every token and byte, and the id two neighbours merge into
    (``left << 32 | right``), as a dictionary and as ascending arrays."""

    tokens: list[bytes]
    ids: dict[bytes, int]
    byte_ids: np.ndarray
    merges: dict[int, int]
    pairs: np.ndarray
    merged: np.ndarray


@lru_cache(maxsize=2)
def vocabulary(path: str, digest: str | None = None) -> Vocabulary:
    """The vocabulary of a file of ``base64 rank`` lines; an id is its token's rank, a lower one merges earlier."""
    with open(path, "rb") as file:
        content = file.read()
    if digest and hashlib.sha256(content).hexdigest() != digest:
        raise ValueError(f"{path} differs from the driver's file")
    ids = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}
    tokens = [b""] * (max(ids.values()) + 1)
    merges = {}
    for token, i in ids.items():
        tokens[i] = token
        for cut in range(1, len(token)):
            left, right = ids.get(token[:cut]), ids.get(token[cut:])
            if left is not None and right is not None:
                merges[left << 32 | right] = i
    byte_ids = np.array([ids[bytes([b])] for b in range(256)], np.int64)
    pairs = np.array(sorted(merges) or [-1], np.int64)
    return Vocabulary(tokens, ids, byte_ids, merges, pairs, np.array([merges.get(p, -1) for p in pairs.tolist()], np.int64))


# Words


def _newer(kind: str) -> str:
    """Code points that ``regex`` counts to a class but the Unicode version of ``tiktoken`` does not, as ranges of a class."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    of_bytes = tiktoken.Encoding("bytes", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    known = set(bytes(of_bytes.encode_ordinary(every)).decode())
    runs: list[list[int]] = []
    for code in sorted(ord(c) for c in regex.findall(kind, every) if c not in known):
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"\\U{low:08x}-\\U{high:08x}" for low, high in runs)


@lru_cache(maxsize=2)
def _patterns(pattern: str) -> tuple[regex.Pattern, re.Pattern | None, regex.Pattern]:
    """The pattern, the code points it would take for letters or numbers too early, and a slower pattern for texts that have some."""
    letters, numbers = _newer(r"\p{L}"), _newer(r"\p{N}")
    exact = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s[\p{{L}}--[{letters}]][\p{{N}}--[{numbers}]]]" if letters and numbers else r"[^\s\p{L}\p{N}]")
    for kind, newer in ((r"\p{L}", letters), (r"\p{N}", numbers)):
        if newer:
            exact = re.sub(rf"(?<!\[)(?<!\[\^\\s){re.escape(kind)}", lambda m: f"[{m[0]}--[{newer}]]", exact)
    odd = re.compile(f"[{letters}{numbers}]") if letters or numbers else None
    return regex.compile(pattern), odd, regex.compile(exact, regex.V1)


def split(text: str, pattern: str) -> list[str]:
    """The words of a text: every match of the pattern, letters and numbers being those of the published library."""
    plain, odd, exact = _patterns(pattern)
    return (exact if odd and not text.isascii() and odd.search(text) else plain).findall(text)


# Merge replay


def replayed(words: Sequence[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """Ids of each word, as little-endian unsigned 32-bit numbers.

    A word that is a token has that id; the others are merged together. The pair of lowest
    rank goes first, of equal ones in a word the one furthest left, until no pair can
    merge. A merge may allow one of a lower rank than its own, which is then
    replayed before the rest of that word. Empty words have no ids.
    """
    result = [np.array(vocabulary.ids[w], "<u4").tobytes() if w in vocabulary.ids else b"" for w in words]
    rest = [i for i, ids in enumerate(result) if not ids and words[i]]
    for replay, part in (
        (_replay_places, [i for i in rest if len(words[i]) <= KNOWN_BYTES]),
        (_replay_one_by_one, [i for i in rest if len(words[i]) > KNOWN_BYTES]),
    ):
        if not part:
            continue
        data = np.frombuffer(b"".join(words[i] for i in part), np.uint8)
        ends = np.cumsum([len(words[i]) for i in part])
        token = replay(data, ends, vocabulary)
        left = np.flatnonzero(token >= 0)
        ids, low = token[left].astype("<u4").tobytes(), 0
        for i, high in zip(part, (4 * np.searchsorted(left, ends)).tolist()):
            result[i] = ids[low:high]
            low = high
    return result


def _chain(data: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, ...]:
    """For each byte its id, the places after and before it in its word (-1: none), and the merged id of it and the next (-1: none)."""
    token = vocabulary.byte_ids[data]
    after, before = np.arange(1, len(data) + 1), np.arange(-1, len(data) - 1)
    after[ends - 1] = -1
    before[0] = -1
    before[ends[:-1]] = -1
    pair = np.full(len(data), -1, np.int64)
    at = np.flatnonzero(after >= 0)
    pair[at] = _merged(token[at], token[at + 1], vocabulary)
    return token, after, before, pair


def _merged(left: np.ndarray, right: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    key = left << 32 | right
    place = np.minimum(np.searchsorted(vocabulary.pairs, key), len(vocabulary.pairs) - 1)
    return np.where(vocabulary.pairs[place] == key, vocabulary.merged[place], -1)


def _by_rank(at: np.ndarray, pair: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places that may merge, by merged id, each ascending."""
    at = at[pair >= 0]
    pair = pair[pair >= 0]
    order = np.lexsort((at, pair))
    at, pair = at[order], pair[order]
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    bounds = [*first.tolist(), len(at)]
    for rank, low, high in zip(pair[first].tolist(), bounds, bounds[1:]):
        yield rank, at[low:high]


def _replay_places(data: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Short words: all places of a merge at once, in each word the first of them."""
    token, after, before, pair = _chain(data, ends, vocabulary)
    word = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    index = {rank: [places] for rank, places in _by_rank(np.arange(len(data)), pair)}
    ranks = sorted(index)
    while ranks:
        rank = ranks[0]
        waiting = index[rank]
        if not waiting:
            heappop(ranks)
            del index[rank]
            continue
        at = waiting[0] if len(waiting) == 1 else np.unique(np.concatenate(waiting))
        at = at[pair[at] == rank]  # others have a neighbour that has merged since
        of_word = word[at]
        first = np.ones(len(at), bool)
        first[1:] = of_word[1:] != of_word[:-1]
        index[rank] = [] if first.all() else [at[~first]]
        at = at[first]
        gone = after[at]
        beyond = after[gone]
        token[at], token[gone], pair[gone], pair[at] = rank, -1, -1, -1
        after[at] = beyond
        followed = beyond >= 0
        before[beyond[followed]] = at[followed]
        previous = before[at]
        touched = np.concatenate((at[followed], previous[previous >= 0]))
        pair[touched] = found = _merged(token[touched], token[after[touched]], vocabulary)
        for merged, places in _by_rank(touched, found):
            if merged in index:
                index[merged].append(places)
            else:
                index[merged] = [places]
                heappush(ranks, merged)
    return token


def _replay_one_by_one(data: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Words of any length, one place at a time: the time grows with the bytes, not with places times rounds."""
    token, after, before, pair = (x.tolist() for x in _chain(data, ends, vocabulary))
    index = {rank: places.tolist() for rank, places in _by_rank(np.arange(len(data)), np.array(pair))}
    ranks = sorted(index)
    merges = vocabulary.merges
    while ranks:
        rank = ranks[0]
        if not index[rank]:
            heappop(ranks)
            del index[rank]
            continue
        at = heappop(index[rank])
        if pair[at] != rank:
            continue
        gone = after[at]
        beyond = after[gone]
        token[at], token[gone], pair[gone], pair[at], after[at] = rank, -1, -1, -1, beyond
        if beyond >= 0:
            before[beyond] = at
        for place in (at, before[at]):
            if place < 0 or after[place] < 0:
                continue
            pair[place] = merged = merges.get(token[place] << 32 | token[after[place]], -1)
            if merged in index:
                heappush(index[merged], place)
            elif merged >= 0:
                index[merged] = [place]
                heappush(ranks, merged)
    return np.array(token, np.int64)


# Columns


class Encoder:
    """Ids of many texts at a time; remembers a bounded number of merged words."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern = vocabulary, pattern
        self.known: dict[str, bytes] = {}

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        parts = [split(text, self.pattern) for text in texts]
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        known = self.known
        new = list({word for words in parts for word in words if word not in known})
        coded = [word.encode() for word in new]
        found = dict(zip(new, replayed(coded, self.vocabulary)))
        of_word = known | found if len(found) < len(known) else found | known
        result = [b"".join(map(of_word.__getitem__, words)) for words in parts]
        room = KNOWN_WORDS
        for word, utf8 in zip(new, coded):
            if room <= 0:
                break
            if len(utf8) <= KNOWN_BYTES:
                known[word] = found[word]
                room -= 1
        return result


def encoded(docs: DataFrame, path: str, pattern: str, round_trip: bool = False) -> DataFrame:
    """``docs`` (text, ...) with ``ids``: the whole text's ids as little-endian unsigned 32-bit numbers in a binary.

    ``path`` names a file of ``base64 rank`` lines that every executor has; its
    content must be the driver's. Each match of ``pattern`` is encoded by itself,
    names of special tokens are plain text. With ``round_trip`` the bytes that the ids stand for follow as ``decoded``, in
    the same Python workers. Null and empty texts have no ids. Columns of the names added are
    replaced, other columns stay; repeated rows and ties are coded alike, a text of any
    length is coded whole, an empty table stays empty. No row leaves its task.
    """
    with open(path, "rb") as file:
        digest = hashlib.sha256(file.read()).hexdigest()

    @F.arrow_udf("struct<ids:binary,decoded:binary>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = vocabulary(path, digest)
        encoder = Encoder(known, pattern)
        for texts in batches:
            done: list[bytes] = []
            for low, high in chunks(texts, TEXT_BYTES):
                done += encoder.encode([text or "" for text in texts.slice(low, high - low).to_pylist()])
            ids = pa.array(done, pa.binary())
            done = [_bytes_of(x, known.tokens) if round_trip else None for x in done]
            yield pa.StructArray.from_arrays([ids, pa.array(done, pa.binary())], names=["ids", "decoded"])

    names = ("ids", "decoded")[: 1 + round_trip]
    kept = docs.drop(*names)
    found = kept.select("*", coded(F.col("text").cast("string")).alias("_coded"))
    return found.select(*(found[f"`{name}`"] for name in kept.columns), *(F.col("_coded")[name].alias(name) for name in names))


def decoded(ids: Column, path: str) -> Column:
    """The bytes that ids, as ``encoded`` gives them, stand for; null for null, an error for an id that is no token."""

    @F.arrow_udf("binary")
    def content(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = vocabulary(path).tokens
        for column in batches:
            yield pa.array([None if x is None else _bytes_of(x, tokens) for x in column.to_pylist()], pa.binary())

    return content(ids)


def _bytes_of(ids: bytes, tokens: list[bytes]) -> bytes:
    found = [tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]
    if not all(found):
        raise ValueError("an id that is no token")
    return b"".join(found)
