"""How quality filters overlap: every order of five filters, counted from additive counts per set of failures.

Texts that repeat are found with a counting Bloom sketch first: tasks count the cells of their texts' hashes, the
counts are merged, and a text with a cell nobody else has is known to be unique. Only the others are
grouped by their full text, for the smallest doc_id of each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.text import mixed
from clicktrail.sources.shared import discard, staged

# The filters, each the bit of its place in a mask of failures, and the white space around words.
FILTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Sketch:
    """Parameters: cells per text, cells a text counts in, and the bound of all cells, a bit each when merged (64 MB).

    Beyond the bound the sketch clears fewer texts and more of them are grouped by
    full text; results do not change."""

    cells_per_text: int = 16
    hashes: int = 4
    most_cells: int = 1 << 29
    block: int = 1 << 16


def _cells(hashes: np.ndarray, cells: int, sketch: Sketch) -> np.ndarray:
    """The cells of each hash, a row per hash function; ``cells`` is a power of two."""
    hashes = hashes.view(np.uint64)
    one, two = mixed(hashes), mixed(hashes ^ np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return np.stack([(one + np.uint64(i) * two) & np.uint64(cells - 1) for i in range(sketch.hashes)])


def repeated_cells(hashes: DataFrame, texts: int, sketch: Sketch = Sketch()) -> np.ndarray:
    """One bit per cell: whether more than one of the ``hashes`` (hash long), copies included, counts in it.

    Each task counts its own hashes per cell, up to two; the counts of all tasks are
    summed per block of cells, in two steps so that no task gathers much of
    them. The bits, bounded by ``most_cells``, are all that reaches the driver.
    """
    cells = sketch.block
    while cells < min(texts * sketch.cells_per_text, sketch.most_cells):
        cells *= 2

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values in _gathered(batches, sketch.block * 16):
            found, times = np.unique(values, return_counts=True)
            own = np.sort(_cells(found, cells, sketch), axis=0)
            own_cell = np.ones(own.shape, bool)  # two of a hash's cells may be one: a text counts there once
            own_cell[1:] = own[1:] != own[:-1]
            cell, place = np.unique(own[own_cell], return_inverse=True)
            count = np.bincount(place, weights=np.broadcast_to(np.minimum(times, 2), own.shape)[own_cell])
            block = (cell // np.uint64(sketch.block)).astype(np.int64)
            first = np.flatnonzero(np.diff(block, prepend=-1))
            within, count = (cell % np.uint64(sketch.block)).astype("<u2"), np.minimum(count, 2).astype(np.uint8)
            parts = ([x.tobytes() for x in np.split(values, first[1:])] for values in (within, count))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[first], pa.int32()), *(pa.array(x, pa.binary()) for x in parts)], names=["block", "cells", "counts"]
            )

    def total(group: pa.Table) -> np.ndarray:
        sums = np.zeros(sketch.block, np.uint8)
        for cell, count in zip(group.column("cells"), group.column("counts")):
            at = np.frombuffer(cell.as_buffer(), "<u2")  # distinct cells
            sums[at] = np.minimum(sums[at] + np.frombuffer(count.as_buffer(), np.uint8), 2)
        return sums

    def summed(group: pa.Table) -> pa.Table:
        sums = total(group)
        at = np.flatnonzero(sums)
        found = pa.array([at.astype("<u2").tobytes()], pa.binary()), pa.array([sums[at].tobytes()], pa.binary())
        return pa.table({"block": group.column("block").slice(0, 1), "cells": found[0], "counts": found[1]})

    def merged(group: pa.Table) -> pa.Table:
        bits = np.packbits(total(group) > 1, bitorder="little").tobytes()
        return pa.table({"block": group.column("block").slice(0, 1), "bits": pa.array([bits], pa.binary())})

    counts = "block int, cells binary, counts binary"
    blocks = (
        hashes.mapInArrow(counted, counts)
        .withColumn("share", F.spark_partition_id() % 8)
        .groupBy("block", "share")
        .applyInArrow(summed, counts)
        .groupBy("block")
        .applyInArrow(merged, "block int, bits binary")
        .toArrow()
    )
    bits = np.zeros(cells // 8, np.uint8)
    for block, found in zip(blocks.column("block").to_pylist(), blocks.column("bits").to_pylist()):
        low = block * sketch.block // 8
        bits[low : low + len(found)] = np.frombuffer(found, np.uint8)
    return bits


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[np.ndarray]:
    """The numbers of the first column, about ``rows`` at a time."""
    waiting: list[np.ndarray] = []
    for batch in batches:
        waiting.append(np.asarray(batch.column(0)))
        if sum(map(len, waiting)) >= rows:
            yield np.concatenate(waiting)
            waiting = []
    if sum(map(len, waiting)):
        yield np.concatenate(waiting)


def _perhaps_repeated(df: DataFrame, hash_column: str, bits: np.ndarray, sketch: Sketch) -> Column:
    """Whether the sketch does not rule out that the text of a hash occurs more than once."""
    shared = df.sparkSession.sparkContext.broadcast(bits.tobytes())

    @F.arrow_udf("boolean")
    def known(hashes: pa.Array) -> pa.Array:
        cells = np.frombuffer(shared.value, np.uint8)
        at = _cells(np.asarray(hashes.fill_null(0)), len(cells) * 8, sketch)
        hit = (cells[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
        return pa.array(hit.all(axis=0))

    return known(hash_column)


def own_failures(text: Column) -> Column:
    """Mask of the filters that judge a text by itself: A few words, B few distinct words, C many capitals, D odd characters."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n, different = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    failed = (n < 200, different * 100 < n * 50, capitals * 100 > F.length(text) * 3, text.rlike("[#$%&*|]"))
    mask = F.lit(0)
    for bit, condition in enumerate(failed):
        mask = mask + F.when(condition, 1 << bit).otherwise(0)
    return mask


def _bit_of_copy(low: str) -> Column:
    return F.when(F.col(low) < F.col("doc_id"), 1 << FILTERS.index("E")).otherwise(0)


def mask_counts(docs: DataFrame, labels: DataFrame, sketch: Sketch = Sketch(), hashed=F.xxhash64) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, lang, ...) per part and mask of the filters they fail: part, mask, n, good, toxic.

    A part is a lang, null counts as empty. ``good`` and ``toxic`` are the rows whose doc_id has a row
    with quality = 1 or toxic = 1 in ``labels`` (doc_id, quality, toxic, ...). Filter E fails where
    a smaller doc_id has the identical text; a null doc_id is smaller than none and
    none is smaller than it. Null texts are empty, texts count whole, rows may
    repeat, empty tables give an empty result, other columns are not read.

    Texts the sketch does not clear are grouped in full, with partial minima before the
    shuffle: a text that a third of the rows share costs a row per task. Only
    hashes go back to the rows. Where one hash stands for several texts, their
    rows meet their full texts instead. Counts are added up before and after every shuffle.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    part = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), text.alias("text"), hashed(text).alias("hash"))
    own = staged(rows.select("doc_id", "part", "hash", own_failures(F.col("text")).alias("own")), "own_failures")
    bits = repeated_cells(own.select("hash"), own.count(), sketch)

    possible = rows.where("doc_id IS NOT NULL").where(_perhaps_repeated(rows, "hash", bits, sketch))
    smallest = possible.groupBy("hash", "text").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n"))
    per_hash = smallest.groupBy("hash").agg(F.min("low").alias("low"), F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n"))
    per_hash = staged(per_hash.where("n > 1"), "repeated_hashes")
    several = staged(per_hash.where("texts > 1").select("hash"), "hashes_of_several_texts")  # nearly always empty

    found = own.join(per_hash.select("hash", "low", "texts"), "hash", "left").where("texts IS NULL OR texts = 1")
    masks = found.select("doc_id", "part", (F.col("own") + _bit_of_copy("low")).alias("mask"))
    unlike = rows.join(several, "hash", "left_semi")
    lows = unlike.groupBy("hash", "text").agg(F.min("doc_id").alias("low"))
    unlike = unlike.join(lows, ["hash", "text"], "left")
    masks = masks.unionAll(unlike.select("doc_id", "part", (own_failures(F.col("text")) + _bit_of_copy("low")).alias("mask")))

    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    sums = (F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name) for name in ("good", "toxic"))
    counts = masks.join(known, "doc_id", "left").groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *sums)
    counts = staged(counts, "mask_counts")
    for made in (own, per_hash, several):
        discard(made)
    return counts


def audited(counts: DataFrame) -> DataFrame:
    """Per part of ``mask_counts``, order of the filters and step: what its filter does there.

    part, filter_order, step, then rows kept after the step, removed by it, redundant (failing the filter but
    removed earlier), unique_fails (failing only this filter), good_lost and toxic_lost among the removed,
    and shapley: the rows the filter removes, summed over all orders. In an order a filter removes the
    rows that fail it and none before it, so all counts are sums over masks. A
    part has 600 rows, whatever its size; an empty table none.
    """
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            steps.append({"filter_order": "".join(order), "step": step, "bit": bit, "before": before})
            before |= bit
    masks = 1 << len(FILTERS)
    orders = len(steps) // len(FILTERS)
    per_mask = (
        F.array(*(F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(name))), F.lit(0)).cast("long") for m in range(masks))).alias(name)
        for name in ("n", "good", "toxic")
    )
    listed = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, bit int, before int>>")
    rows = counts.groupBy("part").agg(*per_mask).select("*", F.inline(listed))

    def rows_of(name: str, condition, times=lambda m: F.lit(1)) -> Column:
        those = F.filter(F.sequence(F.lit(0), F.lit(masks - 1)), condition)
        return F.aggregate(those, F.lit(0).cast("long"), lambda total, m: total + F.col(name)[m] * times(m))

    bit, before = F.col("bit"), F.col("before")
    fails, open_yet = (lambda m: m.bitwiseAND(bit) != 0), (lambda m: m.bitwiseAND(before) == 0)
    removed = lambda m: fails(m) & open_yet(m)
    return rows.select(
        "part",
        "filter_order",
        "step",
        rows_of("n", lambda m: ~fails(m) & open_yet(m)).alias("kept"),
        rows_of("n", removed).alias("removed"),
        rows_of("n", lambda m: fails(m) & ~open_yet(m)).alias("redundant"),
        rows_of("n", lambda m: m == bit).alias("unique_fails"),
        rows_of("good", removed).alias("good_lost"),
        rows_of("toxic", removed).alias("toxic_lost"),
        # of the filters a row fails, each comes first in equally many orders
        rows_of("n", fails, lambda m: (F.lit(orders) / F.bit_count(m)).cast("long")).alias("shapley"),
    )
