"""Near-duplicate vectors by random-hyperplane sign hashing.

Each table gives a vector one bit per random hyperplane: the side it lies on.
Vectors with the same bits in a table share a bucket. There the bits of all
tables are compared first; only vectors that have a partner with few differing
bits, not met in an earlier table, are sent on and compared by exact cosine. Equal
vectors are one class, so copies meet in no bucket. A large bucket is cut into
blocks by hash and every two blocks meet in one cell, which holds a bounded number
of rows, so no bucket needs a cap.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.llm import cells
from clicktrail.llm.components import connected_components
from clicktrail.sources.shared import staged

PAIRS_AT_ONCE = 1 << 15  # pairs whose bits one step compares


@dataclass(frozen=True)
class SignHashing:
    """Parameters. A table has as many bits as log2 of the vectors (8 to 48), so
    buckets stay small as the input grows; as many tables are made as it takes to
    meet a pair of cosine ``threshold`` with probability ``recall``. The bits of a
    pair may differ in as many places as expected at the threshold and ``deviations``
    standard deviations more, which loses far fewer pairs than the tables do."""

    threshold: float = 0.98
    recall: float = 0.9999
    deviations: float = 7.0
    block: int = 1024
    seed: int = 11

    def shape(self, vectors: int) -> tuple[int, int]:
        bits = min(48, max(8, math.ceil(math.log2(max(2, vectors)))))
        alike = 1 - math.acos(self.threshold) / math.pi
        return bits, math.ceil(math.log(1 - self.recall) / math.log(1 - alike**bits))

    def most_differing(self, all_bits: int) -> int:
        differ = math.acos(self.threshold) / math.pi
        return math.floor(all_bits * differ + self.deviations * math.sqrt(all_bits * differ * (1 - differ)))


def near_duplicate_vectors(vectors: DataFrame, hashing: SignHashing = SignHashing()) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding, label, ...): vec_id, n_links, component_id, kept.

    Rows link when their labels are equal and not null, their vectors equally
    long and their cosine in double precision is at least the threshold. n_links
    counts the rows of other vec_ids linked directly, copies included, for each row
    of the vec_id; component_id is the smallest vec_id that links reach, kept tells
    whether it is the row's own.

    Vectors that are null, empty, zero or hold nulls, NaN or infinities, rows
    without label and rows without vec_id link with nothing (component_id is
    their own vec_id, so null and not kept without one). Rows that share a vec_id
    are one vector that has all their links. Other columns of any name are not
    read. An empty table gives an empty result.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.expr("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
        & F.expr("exists(embedding, x -> x <> 0)")
    )
    own = staged(rows.withColumn("usable", F.coalesce(usable, F.lit(False))), "vectors")
    classes = staged(
        own.where("usable")
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
        .withColumn("class", F.monotonically_increasing_id()),
        "vector_classes",
    )
    bits, tables = hashing.shape(classes.count())
    found = staged(_compared(classes, hashing, bits, tables), "vector_links")
    linked = found.groupBy("class").agg(F.sum("links").alias("links"))
    one = classes.where("copies = 1").select(F.col("node").alias("vec_id"), "class", "node", "copies", F.col("copies").alias("rows"))
    # rows of a class lie in one key; the join is a plain one, so adaptive execution splits a hot class
    more = own.where("usable").join(classes.where("copies > 1"), ["label", "embedding"])
    more = more.groupBy("vec_id", "class", "node", "copies").agg(F.count(F.lit(1)).alias("rows"))
    with_links = one.unionAll(more).join(linked, "class", "left")
    with_links = with_links.select("vec_id", "class", "node", "rows", (F.col("copies") + F.coalesce("links", F.lit(0))).alias("linked"))
    member = staged(with_links, "vector_members")
    # a vec_id joins all classes it stands in; classes of one node share that vec_id
    same = member.where("vec_id <> node").select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    between = found.where("node <> lowest").select(F.col("node").alias("a"), F.col("lowest").alias("b"))
    label = connected_components(same.unionAll(between)).withColumnRenamed("node", "vec_id")
    within = _within_vec_ids(member, classes, hashing).groupBy("vec_id", "class").agg(F.sum("links").alias("within"))
    others = F.col("linked") - F.col("rows") - F.coalesce("within", F.lit(0))
    links = member.join(within, ["vec_id", "class"], "left").groupBy("vec_id").agg(F.sum(F.col("rows") * others).alias("n_links"))
    result = (
        own.select("vec_id")
        .join(links, "vec_id", "left")
        .join(label, "vec_id", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    )
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _planes(dimension: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dimension]).standard_normal((dimension, bits * tables))


def _unit(lists: pa.Array) -> list[np.ndarray]:
    """Each vector at length one, in double precision."""
    flat = np.asarray(lists.flatten(), dtype=np.float64)
    ends = np.cumsum(np.asarray([len(x) for x in lists], dtype=np.int64))
    found = []
    for low, high in zip([0, *ends[:-1]], ends):
        v = flat[low:high] / np.abs(flat[low:high]).max()
        found.append(v / math.sqrt(v @ v))
    return found


def _codes(classes: DataFrame, hashing: SignHashing, bits: int, tables: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = (1 << np.arange(bits, dtype=np.int64))
        for batch in batches:
            units = _unit(batch.column(0))
            codes = np.empty((len(units), tables), np.int32 if bits < 32 else np.int64)
            lengths = np.array([len(u) for u in units], np.int64)
            for dimension in np.unique(lengths):
                rows = np.flatnonzero(lengths == dimension)
                side = np.stack([units[i] for i in rows]) @ _planes(int(dimension), bits, tables, hashing.seed) > 0
                codes[rows] = side.reshape(len(rows), tables, bits) @ weights
            offsets = pa.array(np.arange(len(units) + 1, dtype=np.int32) * tables)
            columns = [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(codes.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, names=["embedding", "label_key", "class", "node", "copies", "codes"])

    source = classes.select("embedding", F.col("label").cast("string").alias("label_key"), "class", "node", "copies")
    kind = source.schema["embedding"].dataType.simpleString()
    return source.mapInArrow(build, f"embedding {kind}, label_key string, class long, node long, copies long, codes array<{'int' if bits < 32 else 'long'}>")


_BUCKET = ["table", "label_key", "size", "code"]


def _compared(classes: DataFrame, hashing: SignHashing, bits: int, tables: int) -> DataFrame:
    """(class, node, links, lowest): for each cell a class lies in, the rows it links with there and the smallest node they reach."""
    coded = staged(_codes(classes, hashing, bits, tables), "vector_codes").withColumn("size", F.size("embedding"))
    # buckets are counted by hash, so a count may be too high, never too low
    placed = coded.select("class", "label_key", "size", F.posexplode("codes").alias("table", "code"))
    placed = placed.select("class", "table", F.xxhash64(*_BUCKET).alias("bucket"))
    counts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = staged(placed.join(counts, "bucket").select("class", "table", "n"), "shared_buckets")
    code = F.expr("codes[table]").alias("code")
    without_vectors = coded.select("class", "label_key", "size", "codes")
    near = _with_partners(shared.join(without_vectors, "class").select("*", code), hashing, hashing.most_differing(bits * tables))
    near = staged(near.distinct(), "vectors_to_compare")
    return _met(near.join(coded, "class").select("*", code), F.col("n"), hashing)


def _with_partners(rows: DataFrame, hashing: SignHashing, most: int) -> DataFrame:
    """(class, table, n) of the rows whose bits differ in at most so many places from those of another row of the bucket, if no earlier table has met the two."""
    met = cells.dealt(rows, _BUCKET, F.col("n"), "class", hashing.block, ["class", "n", "codes"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, cuts in cells.whole(batches, _BUCKET):
            kept = found.select(["class", "table", "n"]).filter(pa.array(_partnered(found, cuts, most)))
            yield from kept.to_batches()

    return met.mapInArrow(search, "class long, table int, n long")


def _partnered(rows: pa.Table, cuts: list[int], most: int) -> np.ndarray:
    """Which rows have a partner in their cell. A row's partners are a run of rows after it, so pairs of all cells are compared together."""
    low, high, block, table = (rows.column(name).to_numpy() for name in ("low", "high", "block", "table"))
    codes = np.asarray(rows.column("codes").combine_chunks().flatten()).reshape(rows.num_rows, -1)
    begin, end = np.array(cuts[:-1]), np.array(cuts[1:])
    cell = np.repeat(np.arange(len(begin)), end - begin)
    order = np.lexsort((block, cell))  # the low block first; cells stay where they are
    in_low = block[order] == low
    second = begin + np.add.reduceat(in_low, begin, dtype=np.int64)
    start = np.where(low == high, np.arange(rows.num_rows) + 1, second[cell])
    partners = np.where(in_low, end[cell] - start, 0)
    until = np.cumsum(partners)
    found = np.zeros(rows.num_rows, bool)
    first = 0
    while first < rows.num_rows:
        done = until[first] - partners[first]
        last = max(first + 1, int(np.searchsorted(until, done + PAIRS_AT_ONCE, side="right")))
        i = np.repeat(np.arange(first, last), partners[first:last])
        j = start[i] + done + np.arange(len(i)) - (until - partners)[i]
        differ = codes[order[i]] ^ codes[order[j]]
        near = np.bitwise_count(differ).sum(axis=1) <= most
        i, j, differ = order[i[near]], order[j[near]], differ[near]
        earlier = np.arange(codes.shape[1]) < table[i][:, None]
        fresh = ~((differ == 0) & earlier).any(axis=1)
        found[i[fresh]] = found[j[fresh]] = True
        first = last
    return found


def _within_vec_ids(member: DataFrame, classes: DataFrame, hashing: SignHashing) -> DataFrame:
    """(vec_id, class, links): the rows of the same vec_id in other classes that a class links with."""
    several = member.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    split = member.join(several, "vec_id").select("vec_id", "class", "rows", "n")
    rows = split.join(classes.select("class", "label", "embedding"), "class").select(
        F.lit(0).alias("table"),
        F.col("label").cast("string").alias("label_key"),
        F.size("embedding").alias("size"),
        F.col("vec_id").alias("code"),
        "n",
        "class",
        F.col("vec_id").alias("node"),
        F.col("rows").alias("copies"),
        F.array(F.col("vec_id")).alias("codes"),
        "embedding",
    )
    return _met(rows, F.col("n"), hashing).select(F.col("node").alias("vec_id"), "class", "links")


def _met(rows: DataFrame, size: Column, hashing: SignHashing) -> DataFrame:
    """(class, node, links, lowest) of the classes that link within a bucket; ``size`` bounds the bucket's rows."""
    columns = ["class", "node", "copies", "codes", "embedding"]
    met = cells.dealt(rows, _BUCKET, size, "class", hashing.block, columns)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, cuts in cells.whole(batches, _BUCKET):
            yield from _links_in_cells(found, cuts, hashing.threshold)

    return met.mapInArrow(compare, "class long, node long, links long, lowest long")


def _links_in_cells(rows: pa.Table, cuts: list[int], threshold: float) -> Iterator[pa.RecordBatch]:
    out: list[tuple[np.ndarray, ...]] = []
    column = {name: rows.column(name).to_numpy() for name in ("low", "high", "block", "class", "node", "copies", "table")}
    for low, high in zip(cuts[:-1], cuts[1:]):
        if high - low < 2:
            continue
        part = slice(low, high)
        embedding, codes = (rows.column(name).slice(low, high - low).combine_chunks() for name in ("embedding", "codes"))
        unit = np.stack(_unit(embedding))
        seen = np.asarray(codes.flatten()).reshape(high - low, -1)[:, : column["table"][low]]
        first = np.flatnonzero(column["block"][part] == column["low"][low])
        second = np.flatnonzero(column["block"][part] == column["high"][low])
        i, j = np.nonzero(unit[first] @ unit[second].T >= threshold)
        i, j = first[i], second[j]
        once = i < j if column["low"][low] == column["high"][low] else np.ones(len(i), bool)
        i, j = i[once], j[once]
        if not len(i):
            continue
        fresh = np.ones(len(i), bool)  # pairs that no earlier table has met
        for t in range(seen.shape[1]):
            fresh &= seen[i, t] != seen[j, t]
        node, copies = column["node"][part], column["copies"][part]
        links = np.zeros(high - low, np.int64)
        np.add.at(links, i[fresh], copies[j[fresh]])
        np.add.at(links, j[fresh], copies[i[fresh]])
        lowest = node.copy()
        while True:
            before = lowest.copy()
            np.minimum.at(lowest, i, before[j])
            np.minimum.at(lowest, j, before[i])
            if (before == lowest).all():
                break
        touched = np.unique(np.concatenate([i, j]))
        out.append((column["class"][part][touched], node[touched], links[touched], lowest[touched]))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["class", "node", "links", "lowest"])
