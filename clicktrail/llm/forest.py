"""Near-duplicate documents by a MinHash LSH forest.

Several trees each order all documents by their own eight 16-bit MinHash values.
Documents that are neighbours in such an order share the longest prefixes, so
every document is paired with its next few neighbours as long as they share at
least ``min_depth`` values. Depth adapts to the region: where few documents share
a prefix all of them are paired at ``min_depth``, in a dense region the nearest
neighbours are those with the deepest common prefix. Documents of dense regions
that links have not put into one component yet meet in an exact set join: those
whose rarest shingles have one in common. Pairs are confirmed on the full shingle
sets, so no false pair links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.llm import cells
from clicktrail.llm import text as tx
from clicktrail.llm.components import connected_components
from clicktrail.sources.shared import staged

DEPTH = 8  # values of a tree's signature, 16 bits each


@dataclass(frozen=True)
class Forest:
    """Parameters of the forest.

    With ``trees`` trees a pair of similarity s shares ``min_depth`` values in at
    least one with probability 1 - (1 - s**min_depth)**trees: 0.99999 at 0.8.
    ``sketch_distance`` drops pairs whose one-bit sketches (one bit per value)
    differ in more places; at similarity 0.8 the mean is a tenth of the bits, and
    the default is over five standard deviations above that.
    ``block`` bounds the documents with a rare shingle that meet as many others in
    a task; shingles are ordered by counts in ``counters`` hash counters.
    """

    shingle: int = 5
    percent: int = 80
    trees: int = 24
    min_depth: int = 4
    neighbours: int = 4
    sketch_distance: int = 42
    block: int = 1024
    counters: int = 1 << 18

    @property
    def values(self) -> int:
        return self.trees * DEPTH

    @property
    def region(self) -> int:
        """Values whose prefix makes a region; the order's first column holds four."""
        return min(self.min_depth, 4)


def near_duplicates(docs: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, ...): doc_id, n_shingles, component_id, kept.

    Documents link when ``100 * |A & B| >= percent * |A | B|`` over their shingle
    sets. component_id is the smallest doc_id that links reach, kept tells whether
    it is the document's own. Texts are compared whole.

    Null or empty texts and texts without words have an empty set and link with
    nothing. Rows that share a doc_id are one document that has all their links;
    rows without doc_id have n_shingles, a null component_id and kept false. Other
    columns of any name are not read. An empty table gives an empty result.

    Equal sets (64-bit hash of the set) are one class with one representative, so
    copies are never paired with each other. A pair meets if it shares
    ``min_depth`` values in some tree, however many documents lie between.
    """
    rows = staged(_sets_of(docs.select("doc_id", "text"), forest), "shingles")
    classes = staged(
        rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("set_hash", "n_shingles")
        .agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch")),
        "classes",
    )
    member = rows.where("n_shingles > 0 AND doc_id IS NOT NULL").join(
        classes.select("set_hash", "n_shingles", "node"), ["set_hash", "n_shingles"]
    )
    same = member.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).where("a <> b")
    links = staged(same.unionAll(_links_between_classes(docs, classes, forest)), "all_links")
    component = connected_components(links)
    label = component.select(F.col("node").alias("doc_id"), F.col("component").alias("_component"))
    group = F.coalesce("_component", "doc_id")
    return (
        rows.select("doc_id", "n_shingles")
        .join(label, "doc_id", "left")
        .select("doc_id", "n_shingles", group.alias("component_id"), F.coalesce(group == F.col("doc_id"), F.lit(False)).alias("kept"))
    )


# Signatures


def _constants(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(7)
    flips = random.integers(0, 2**64, count, dtype=np.uint64)
    return flips, random.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """MinHash values, one row per non-empty set."""
    flips, factors = _constants(count)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    everything = np.concatenate(sets)
    lowest = np.empty((len(sets), count), np.uint64)
    for i in range(count):
        lowest[:, i] = np.minimum.reduceat((everything ^ flips[i]) * factors[i], starts)
    return lowest


def _sets_of(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, n_shingles, set_hash, signature (16-bit values), sketch (a bit per value)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for low, high in tx.chunks(texts):
                sets = tx.shingle_sets(texts.slice(low, high - low), forest.shingle)
                full = [i for i, s in enumerate(sets) if len(s)]
                signature: list[bytes | None] = [None] * len(sets)
                sketch: list[bytes | None] = [None] * len(sets)
                if full:
                    lowest = _signatures([sets[i] for i in full], forest.values)
                    values = ((lowest >> np.uint64(16)) & np.uint64(0xFFFF)).astype(">u2")
                    bits = np.packbits(((lowest >> np.uint64(40)) & np.uint64(1)).astype(np.uint8), axis=1)
                    for row, i in enumerate(full):
                        signature[i], sketch[i] = values[row].tobytes(), bits[row].tobytes()
                hashes = [int((tx.mixed(s).sum() ^ np.uint64(len(s))).view(np.int64)) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(low, high - low),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(hashes, pa.int64()),
                        pa.array(signature, pa.binary()),
                        pa.array(sketch, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "set_hash", "signature", "sketch"],
                )

    schema = "doc_id long, n_shingles long, set_hash long, signature binary, sketch binary"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(build, schema)


# Candidates


def _neighbours(classes: DataFrame, forest: Forest) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, chain) of neighbours in the trees' orders, and the rows (tree, prefix, node) of dense regions.

    chain: next to each other in one of the first three trees. A row is in a dense
    region if more than ``neighbours`` rows on one side share its prefix, so both
    rows of every pair that is too far apart are among them.

    Each tree's order is cut into ranges, so identical signatures of any number
    spread over tasks. Every range also hands out its first and last rows, which
    are paired over the cuts in a second, small step.
    """
    reach = forest.neighbours
    span = reach + 1

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.frombuffer(b"".join(batch.column(2).to_pylist()), ">i8").reshape(-1, 2).astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(np.arange(forest.trees, dtype=np.int32), batch.num_rows)),
                    pa.array(values[:, 0]),
                    pa.array(values[:, 1]),
                    pa.array(np.repeat(batch.column(0).to_numpy(), forest.trees)),
                    pa.array(np.repeat(batch.column(1).to_numpy(), forest.trees)),
                ],
                names=["tree", "p0", "p1", "node", "n"],
            )

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        seen = 0
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not batch.num_rows:
                continue
            fresh = np.arange(len(rows[0])) + (len(kept[0]) if kept else 0)
            if kept:
                rows = [np.concatenate(x) for x in zip(kept, rows)]
            yield _paired(rows, int(fresh[0]), forest)
            yield _dense(rows, int(fresh[0]), forest)
            if seen < span:
                yield _edges([c[fresh[0] :][: span - seen] for c in rows])
            seen += batch.num_rows
            kept = [c[-span:] for c in rows]
        if kept:
            yield _edges(kept)

    forest_rows = "tree int, p0 long, p1 long, node long, n long"
    ordered = (
        classes.select("node", F.col("n_shingles").alias("n"), "signature")
        .mapInArrow(spread, forest_rows)
        .repartitionByRange("tree", "p0", "p1", "node")
        .sortWithinPartitions("tree", "p0", "p1", "node")
    )
    found = staged(ordered.mapInArrow(neighbours, f"{forest_rows}, other long, chain boolean"), "neighbours")
    order = Window.partitionBy("tree").orderBy("p0", "p1", "node")
    cuts = found.where("other IS NULL").select("tree", "p0", "p1", "node", "n").distinct()
    over_cuts = cuts.withColumn(
        "next", F.array(*(F.lead(F.struct("p0", "p1", "node", "n"), i).over(order) for i in range(1, span + 1)))
    ).select("tree", "p0", "p1", "node", "n", F.posexplode("next").alias("step", "b"))
    depth = sum(
        F.when(F.shiftright(F.expr(f"{name} ^ b.{name}"), 48 - 16 * i) == 0, 1).otherwise(0)
        for name, shifts in (("p0", 4), ("p1", 0))
        for i in range(shifts)
    )
    over_cuts = over_cuts.where(F.col("b").isNotNull() & (depth >= forest.region))
    near = over_cuts.where((F.col("step") < reach) & _sizes_fit(forest))
    pairs = found.where("other <> node").select("node", "other", "chain").unionAll(
        near.select("node", F.col("b.node"), (F.col("tree") < 3) & (F.col("step") == 0))
    )
    pairs = (
        pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), "chain")
        .where("a <> b")
        .groupBy("a", "b")
        .agg(F.max("chain").alias("chain"))
    )
    far = over_cuts.where(F.col("step") == reach).select("tree", "p0", F.explode(F.array("node", "b.node")).alias("node"))
    dense = found.where("other = node").select("tree", "p0", "node").unionAll(far)
    prefix = F.shiftright("p0", 64 - 16 * forest.region).alias("prefix")
    return pairs, dense.select("tree", prefix, "node").distinct()


def _sizes_fit(forest: Forest):
    """Sets too different in size cannot be similar enough."""
    small, large = F.least("n", F.col("b.n")), F.greatest("n", F.col("b.n"))
    return small * 100 >= large * forest.percent


def _paired(rows: list[np.ndarray], fresh: int, forest: Forest) -> pa.RecordBatch:
    """Pairs whose later row is at ``fresh`` or after."""
    tree, p0, p1, node, n = rows
    parts = []
    for step in range(1, forest.neighbours + 1):
        later = np.arange(max(fresh, step), len(tree))
        first = later - step
        x0, x1 = (p0[later] ^ p0[first]).view(np.uint64), (p1[later] ^ p1[first]).view(np.uint64)
        depth = sum((x0 >> np.uint64(s) == 0).astype(int) for s in (48, 32, 16, 0))
        depth = depth + (x0 == 0) * sum((x1 >> np.uint64(s) == 0).astype(int) for s in (48, 32, 16, 0))
        small, large = np.minimum(n[later], n[first]), np.maximum(n[later], n[first])
        good = (tree[later] == tree[first]) & (depth >= forest.min_depth) & (small * 100 >= large * forest.percent)
        parts.append((later[good], first[good], np.full(good.sum(), step == 1)))
    later, first, near = (np.concatenate(x) for x in zip(*parts))
    columns = [c[later] for c in rows] + [node[first], near & (tree[later] < 3)]
    return _record(columns, None)


def _dense(rows: list[np.ndarray], fresh: int, forest: Forest) -> pa.RecordBatch:
    """Rows of dense regions, as pairs with themselves; the later row of those that show it is at ``fresh`` or after."""
    tree, p0 = rows[0], rows[1]
    later = np.arange(max(fresh, forest.neighbours + 1), len(tree))
    first = later - forest.neighbours - 1
    far = (tree[later] == tree[first]) & ((p0[later] ^ p0[first]).view(np.uint64) >> np.uint64(64 - 16 * forest.region) == 0)
    at = np.union1d(later[far], first[far])
    return _record([*(c[at] for c in rows), rows[3][at], np.zeros(len(at), bool)], None)


def _edges(rows: list[np.ndarray]) -> pa.RecordBatch:
    return _record([*rows, np.zeros(len(rows[0]), np.int64), np.zeros(len(rows[0]), bool)], np.ones(len(rows[0]), bool))


def _record(columns: list[np.ndarray], null_other: np.ndarray | None) -> pa.RecordBatch:
    arrays = [pa.array(c) for c in columns]
    arrays[5] = pa.array(columns[5], mask=null_other)
    return pa.RecordBatch.from_arrays(arrays, names=["tree", "p0", "p1", "node", "n", "other", "chain"])


# Confirmation


def _links_between_classes(docs: DataFrame, classes: DataFrame, forest: Forest) -> DataFrame:
    """Confirmed links (a, b) that connect classes as all confirmed candidates would.

    First the candidates next to each other in three trees are confirmed, which
    connects dense groups by few links. Of the other candidates, and then of the
    pairs in dense regions, only those between different components are left to
    confirm: the rest could change nothing.
    """
    bits = classes.select("node", *(F.conv(F.hex(F.substring("sketch", 1 + 8 * i, 8)), 16, -10).cast("long").alias(f"s{i}") for i in range(forest.values // 64)))
    names = [c for c in bits.columns if c != "node"]
    pairs, dense = _neighbours(classes, forest)
    for side in ("a", "b"):
        pairs = pairs.join(bits.select(F.col("node").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in names)), side)
    differing = sum(F.bit_count(F.expr(f"a_{c} ^ b_{c}")) for c in names)
    pairs = staged(pairs.where(differing <= forest.sketch_distance).select("a", "b", "chain"), "candidates")
    dense = staged(dense, "dense_regions")

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).unionAll(dense.select("node")).distinct()
    texts = staged(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .where("doc_id IS NOT NULL AND text IS NOT NULL")
        .join(wanted.hint("merge"), "doc_id", "left_semi"),
        "candidate_texts",
    )
    first = staged(_confirmed(pairs.where("chain").select("a", "b"), texts, forest), "confirmed")
    label = connected_components(first)
    rest = pairs.where("NOT chain")
    for side in ("a", "b"):
        rest = rest.join(label.select(F.col("node").alias(side), F.col("component").alias(f"{side}_label")), side, "left")
    rest = rest.where("coalesce(a_label, a) <> coalesce(b_label, b)").select("a", "b")
    known = staged(first.unionAll(_confirmed(rest, texts, forest)), "confirmed")
    unmet = staged(_unmet(dense, connected_components(known), classes, texts), "unmet_texts")
    far = staged(_far_pairs(unmet, forest).distinct(), "far_candidates")
    return known.unionAll(_confirmed(far, unmet.select(F.col("node").alias("doc_id"), "text"), forest))


def _unmet(dense: DataFrame, label: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, component, sketch, text) of the classes in a dense region with more than one component."""
    region = ["tree", "prefix"]
    rows = dense.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    divided = rows.groupBy(*region).agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    # written first, so the join is a plain one and adaptive execution splits a hot region
    nodes = rows.join(staged(divided.select(*region), "divided_regions"), region).select("node", "component").distinct()
    nodes = nodes.join(classes.select("node", "sketch"), "node")
    return texts.withColumnRenamed("doc_id", "node").join(nodes.hint("merge"), "node").select("node", "component", "sketch", "text")


def _far_pairs(unmet: DataFrame, forest: Forest) -> DataFrame:
    """Pairs (a, b) of different components that may be similar enough; a pair may repeat.

    Shingles are ordered by rising count, hash for ties. Two sets that are similar
    enough share a shingle among the first (100 - percent) percent of both, and the
    first one they share leaves room for the overlap they need. The order only has
    to be the same for all, so counting by a hash of fixed width is exact enough.
    """
    last = np.uint64(forest.counters - 1)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in tx.chunks(batch.column(0)):
                sets = tx.shingle_sets(batch.column(0).slice(low, high - low), forest.shingle)
                counter, n = np.unique(np.concatenate(sets) & last, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(counter.astype(np.int64)), pa.array(n)], names=["counter", "n"])

    counts = unmet.select("text").mapInArrow(counted, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(forest.counters, np.int64)
    frequency[counts.column("counter").to_numpy()] = counts.column("n").to_numpy()

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in tx.chunks(batch.column("text")):
                part = batch.slice(low, high - low)
                sets = tx.shingle_sets(part.column("text"), forest.shingle)
                firsts = [s[np.lexsort((s, frequency[s & last]))][: len(s) - -(-len(s) * forest.percent // 100) + 1] for s in sets]
                lengths = np.array([len(x) for x in firsts])
                row = np.repeat(np.arange(len(sets)), lengths)
                columns = [
                    pa.array(np.concatenate(firsts).view(np.int64)),
                    pa.array(np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)),
                    pa.array(np.array([len(s) for s in sets], np.int64)[row]),
                    *(part.column(name).take(pa.array(row)) for name in ("node", "component", "sketch")),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["token", "place", "n", "node", "component", "sketch"])

    schema = "token long, place long, n long, node long, component long, sketch binary"
    rows = staged(unmet.mapInArrow(rarest, schema), "rarest")
    of_token = rows.groupBy("token").agg(F.count(F.lit(1)).alias("members"), F.min("component").alias("x"), F.max("component").alias("y"))
    rows = rows.join(staged(of_token.where("x <> y").select("token", "members"), "shared_tokens"), "token")
    columns = ["place", "n", "node", "component", "sketch"]
    met = cells.dealt(rows, ["token"], F.col("members"), "node", forest.block, columns)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, cuts in cells.whole(batches, ["token"]):
            yield _close(found, cuts, forest)

    return met.mapInArrow(compare, "a long, b long")


def _close(rows: pa.Table, cuts: list[int], forest: Forest) -> pa.RecordBatch:
    """The pairs of cells: a row of the low block with one of the high block, alike in sketch and with room for the overlap."""
    column = {name: rows.column(name).to_numpy() for name in ("low", "high", "block", "place", "n", "node", "component")}
    node, component, n = column["node"], column["component"], column["n"]
    room = n - column["place"]
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint64).reshape(rows.num_rows, -1)
    first, second = [], []
    for low, high in zip(cuts[:-1], cuts[1:]):
        if high - low < 2 or (component[low:high] == component[low]).all():
            continue
        one = column["low"][low] == column["high"][low]
        at = low + np.flatnonzero(column["block"][low:high] == column["low"][low])
        to = low + np.flatnonzero(column["block"][low:high] == column["high"][low])
        for i in np.array_split(at, -(-len(at) // 128)) if len(at) else ():
            good = component[i][:, None] != component[to]
            good &= np.minimum(room[i][:, None], room[to]) * (100 + forest.percent) >= forest.percent * (n[i][:, None] + n[to])
            x, y = np.nonzero(good)
            x, y = i[x], to[y]
            differing = np.bitwise_count(sketch[x] ^ sketch[y]).sum(axis=1)
            close = (differing <= forest.sketch_distance) & ((x < y) | (not one))
            first.append(node[x[close]])
            second.append(node[y[close]])
    a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (first, second))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _confirmed(pairs: DataFrame, texts: DataFrame, forest: Forest) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.add(pc.binary_length(batch.column(2)), pc.binary_length(batch.column(3)))
            ends = np.cumsum(sizes.to_numpy())
            low, done = 0, 0
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(ends, done + tx.CHUNK_BYTES, side="right")))
                part = batch.slice(low, high - low)
                left, right = (tx.shingle_sets(part.column(i), forest.shingle) for i in (2, 3))
                good = [_similar(x, y, forest.percent) for x, y in zip(left, right)]
                low, done = high, int(ends[high - 1])
                yield part.select([0, 1]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"
    )
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(confirm, "a long, b long")


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if not len(x) or not len(y):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)
