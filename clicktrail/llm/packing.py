"""Token sequences of a fixed length packed by best fit and swap-based local search."""

from __future__ import annotations

import json
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from clicktrail.sources.shared import staged

# Fixed value: how a byte-level vocabulary of this kind cuts text before merging; no token crosses a cut.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _letter_bytes() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable ones stand for themselves, the rest follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def _encoding(path: str, added: bool) -> tiktoken.Encoding:
    """The vocabulary of a tokenizers file, whose ids are its merges' ranks, with or without its added tokens."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    letters = _letter_bytes()
    special = {x["content"]: x["id"] for x in found.get("added_tokens", ())}
    ranks = {bytes(letters[c] for c in token): i for token, i in found["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("corpus", pat_str=CUTS, mergeable_ranks=ranks, special_tokens=special if added else {})


def pieces(docs: DataFrame, tokenizer: str, limit: int = 2048, end_id: int = 0, added: bool = False) -> DataFrame:
    """Pieces of each row of ``docs`` (doc_id, text, ...): doc_id, piece, start, length, ids.

    A document is its text's ids, then ``end_id``; null and empty texts are just
    that. The ids are those of the tokenizers library for the file ``tokenizer``,
    computed by the faster tiktoken from the same vocabulary. With ``added`` the name of
    an added token in a text, such as <|endoftext|>, is that token, as the library has it by
    default; without, it is plain text, as with its ``encode_special_tokens``. One longer than
    ``limit`` is cut so that all pieces but the first have ``limit`` ids. ids are little-endian unsigned 32-bit numbers as binary. Rows
    with a null or repeated doc_id have pieces like any other; other columns are not read.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows: list[tuple] = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.array(_encoding(tokenizer, added).encode(text or "", allowed_special="all", disallowed_special=()), "<u4").tobytes() + end
                    total = len(ids) // 4
                    first = total % limit or min(total, limit)
                    starts = [0, *range(first, total, limit)]
                    for piece, (start, stop) in enumerate(zip(starts, [*starts[1:], total])):
                        rows.append((doc_id, piece, start, stop - start, ids[4 * start : 4 * stop]))
                columns = zip(*rows)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids"]
                )

    schema = "doc_id long, piece int, start long, length long, ids binary"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(build, schema)


@dataclass(frozen=True)
class Packing:
    """Parameters: tokens of a sequence, pieces packed together in one task (a bound), and
    from how many free tokens on a sequence is opened again for the next round."""

    limit: int = 2048
    group: int = 20_000
    reopen: int = 32


def packed(rows: DataFrame, packing: Packing = Packing()) -> DataFrame:
    """``rows`` (length, ...) with sequence_id and offset: the place of each in a sequence of at most ``limit``.

    Each round packs the open rows in groups made by hash, with best fit and
    local search; sequences left with ``reopen`` free tokens or more are opened and meet those of
    other groups in the next round. Where that leaves most rows open, as where lengths fit badly, only the emptier
    sequences are opened, in the end those not half full, of which a group has at most one;
    so the rows become fewer until one group is left.
    Offsets have no gaps from 0. Lengths must be 1 to ``limit``; other rows
    raise. Input columns named like the added ones are replaced, rows may repeat,
    an empty table gives an empty result.
    """
    rows = rows.drop("sequence_id", "offset")
    schema = StructType([*rows.schema.fields, *(StructField(n, LongType()) for n in ("sequence_id", "offset", "_free"))])
    rest = staged(rows, "pieces")
    n, done, number, free = rest.count(), [], 0, packing.reopen
    half = packing.limit // 2 + 1
    while True:
        groups = max(1, -(-n // packing.group))
        out = staged(_round(rest, groups, number, schema, packing), "packed")
        if groups == 1:
            done.append(out)
            break
        left = out.where(F.col("_free") >= free).count()
        while left > 0.9 * n and free < half:
            free = min(4 * free, half)
            left = out.where(F.col("_free") >= free).count()
        if left > 0.9 * n:  # groups of a few rows, each less than half a sequence
            done.append(out)
            break
        done.append(out.where(F.col("_free") < free))
        rest, n = out.where(F.col("_free") >= free).drop("sequence_id", "offset", "_free"), left
        number += 1
    result = done[0]
    for more in done[1:]:
        result = result.unionAll(more)
    return result.drop("_free")


def _round(rows: DataFrame, groups: int, number: int, schema: StructType, packing: Packing) -> DataFrame:
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(number)), F.lit(groups)).cast("int")
    names = schema.names[:-3]

    def pack(group: pa.Table) -> pa.Table:
        lengths = group.column("length").to_numpy()
        bins = pack_bins(lengths.tolist(), packing.limit)
        base = (number << 52) + (int(group.column("_group")[0].as_py()) << 24)
        sequence, offset, free = (np.zeros(len(lengths), np.int64) for _ in range(3))
        for i, members in enumerate(bins):
            sizes = lengths[members]
            sequence[members] = base + i
            offset[members] = np.cumsum(sizes) - sizes
            free[members] = packing.limit - sizes.sum()
        out = group.select(names)
        for name, values in (("sequence_id", sequence), ("offset", offset), ("_free", free)):
            out = out.append_column(name, pa.array(values))
        return out

    return rows.withColumn("_group", spread).groupBy("_group").applyInArrow(pack, schema)


def pack_bins(lengths: list[int], limit: int) -> list[list[int]]:
    """Bins of row numbers, each of at most ``limit`` in total, as few as found."""
    if any(not 0 < x <= limit for x in lengths):
        raise ValueError(f"a piece's length must be 1 to {limit}")
    bins = _best_fit(lengths, limit)
    return _local_search(bins, lengths, limit)


def _best_fit(lengths: list[int], limit: int) -> list[list[int]]:
    """Longest first, each into the fullest bin it fits."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms: list[int] = []  # the rooms that some bin has, ascending
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect_left(rooms, lengths[i])
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
        else:
            room, b = limit, len(bins)
            bins.append([])
        bins[b].append(i)
        room -= lengths[i]
        if not by_room[room]:
            insort(rooms, room)
        by_room[room].append(b)
    return bins


def _local_search(bins: list[list[int]], lengths: list[int], limit: int) -> list[list[int]]:
    """Empty the emptiest bins by moves and exchanges that raise the sum of squared fills.

    An item of the emptiest bin moves into another bin's room, or one or two of
    its items change places with a shorter item of a fuller bin. Each step makes
    a fuller bin fuller, so the steps end. A bin that cannot be emptied stays; the search ends when
    the total allows no fewer bins or a pass over all underfull bins found no step.
    """
    fill = np.array([sum(lengths[i] for i in b) for b in bins], np.int64)
    least = -(-int(fill.sum()) // limit)
    bins = [b[:] for b in bins]
    alive = len(bins)
    under = [b for b in range(len(bins)) if fill[b] < limit]
    item = np.array([i for b in under for i in bins[b]], np.int64)
    where = np.array([b for b in under for _ in bins[b]], np.int64)
    size = np.array(lengths, np.int64)[item]
    slot_of = dict(zip(item.tolist(), range(len(item))))

    def put(i: int, source: int, to: int) -> None:
        bins[source].remove(i)
        bins[to].append(i)
        fill[source] -= lengths[i]
        fill[to] += lengths[i]
        where[slot_of[i]] = to

    changed = True
    while changed and alive > least:
        changed = False
        for target in sorted((b for b in under if bins[b]), key=lambda b: fill[b]):
            if alive <= least:
                break
            while bins[target]:
                step = _best_step(bins[target], target, lengths, item, where, size, fill, limit)
                if step is None:
                    break
                changed = True
                given, b, back = step
                for i in given:
                    put(i, target, b)
                if back is not None:
                    put(back, b, target)
            alive -= not bins[target]
    return [b for b in bins if b]


def _best_step(members: list[int], target: int, lengths: list[int], item, where, size, fill, limit: int):
    """The move or exchange that fills another bin most: (items given, that bin, the item that comes back or none).

    For every item elsewhere, ``most`` is the length its place can take; of the totals of one
    or two members the largest up to there is looked up, for all places at once.
    """
    room = np.where((where != target) & (fill[where] >= fill[target]), limit - fill[where], -1)
    by_length = {lengths[i]: i for i in members}
    widest = room.max(initial=-1)
    fitting = [x for x in by_length if x <= widest]
    if fitting:  # a move empties the bin fastest: the longest that fits, where it fits best
        i = by_length[max(fitting)]
        slot = int(np.argmin(np.where(room >= lengths[i], room, limit + 1)))
        return (i,), int(where[slot]), None
    totals = _totals(members, lengths, limit)
    values = np.array(sorted(totals))
    most = size + room
    total = values[np.maximum(np.searchsorted(values, most, side="right") - 1, 0)]
    gain = np.where((room >= 0) & (total <= most), total - size, 0)
    slot = int(np.argmax(gain)) if len(gain) else 0
    if not len(gain) or gain[slot] <= 0:
        return None
    return totals[int(total[slot])], int(where[slot]), int(item[slot])


def _totals(members: list[int], lengths: list[int], limit: int) -> dict[int, tuple[int, ...]]:
    """Every total length of one or two members up to ``limit``, with members that have it, one rather than two."""
    found: dict[int, tuple[int, ...]] = {}
    of_length: dict[int, list[int]] = {}
    for i in members:
        of_length.setdefault(lengths[i], []).append(i)
    for x, own in of_length.items():
        if 2 * x <= limit and len(own) > 1:
            found[2 * x] = (own[0], own[1])
    kinds = sorted(of_length)
    for at, x in enumerate(kinds):
        for y in kinds[at + 1 :]:
            if x + y > limit:
                break
            found[x + y] = (of_length[x][0], of_length[y][0])
    found.update({x: (own[0],) for x, own in of_length.items()})
    return found
