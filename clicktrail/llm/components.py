"""Connected components of a link table, by stars: within tasks, then by rounds of Spark joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.sources.shared import discard, staged

LINKS_PER_TASK = 500_000  # 8 MB


def connected_components(links: DataFrame, links_per_task: int = LINKS_PER_TASK) -> DataFrame:
    """``links`` (a, b long) to (node, component): the smallest node that links reach.

    First every task replaces its share of the links, about ``links_per_task``, by
    stars: each of its nodes linked to the smallest one it reaches there. Then two
    steps alternate until all links are stars: every node connects its larger
    neighbours to its smallest one, then its smaller neighbours. The number of
    links never grows, and rounds grow with the logarithm of the nodes. Every size
    takes this way; a table that one task holds needs no round. Each step's
    smallest neighbours are written first, so the join that hands them out is a
    plain join whose hot keys adaptive execution splits, and a lost executor
    repeats one step only. Two numbers per call and one row per round reach the driver.

    Nulls, self-links and repeated links are ignored; nodes in no link are not
    in the result, an empty table gives an empty result.
    """
    given = staged(
        links.where("a <> b")
        .select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))
        .distinct(),
        "links",
    )
    tasks = max(1, -(-given.count() // links_per_task))
    edges = staged(given.coalesce(tasks).mapInArrow(_stars, "u long, v long"), "links")
    discard(given)
    while not _all_stars(edges):
        edges = _replaced(edges, _large_star, tasks)
        edges = _replaced(edges, _small_star, tasks)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as links to the smallest node that each node reaches there."""
    pairs = [np.stack([c.to_numpy() for c in batch.columns], axis=1) for batch in batches]
    if not pairs:
        return
    nodes, place = np.unique(np.concatenate(pairs), return_inverse=True)
    a, b = place.reshape(-1, 2).T
    lowest = np.arange(len(nodes))
    while True:  # hook each root to a smaller one across a link, then follow to the roots
        x, y = lowest[a], lowest[b]
        if (x == y).all():
            break
        np.minimum.at(lowest, np.maximum(x, y), np.minimum(x, y))
        while (lowest != lowest[lowest]).any():
            lowest = lowest[lowest]
    leaf = lowest != np.arange(len(nodes))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[leaf]), pa.array(nodes[lowest[leaf]])], names=["u", "v"])


def _all_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one link and is no other link's smaller end."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionAll(edges.select("v", F.lit(0)))
    node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("links"))
    return node.where("up > 0 AND links > 1").isEmpty()


def _replaced(edges: DataFrame, step, tasks: int) -> DataFrame:
    """The links after a step, written by so many tasks: links become no more, so no task's share grows."""
    lowest, result = step(edges, tasks)
    result = staged(result.where("u <> v").distinct().coalesce(tasks), "links")
    discard(lowest)
    discard(edges)
    return result


def _large_star(edges: DataFrame, tasks: int) -> tuple[DataFrame, DataFrame]:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = staged(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")).coalesce(tasks), "lowest")
    return lowest, both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, tasks: int) -> tuple[DataFrame, DataFrame]:
    lowest = staged(edges.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks), "lowest")
    moved = edges.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lowest, moved.unionAll(lowest.select("u", F.col("m").alias("v")))
