"""Exact top-k inner products by MaxScore over sharded postings.

A term is a dimension, its postings are a shard's vectors ordered by row. The
largest product a term can add bounds its score. With the k-th best score so far
as threshold, terms whose bounds together stay below it are non-essential: the
essential postings are traversed, and the others' terms are probed as long as score
plus remaining bounds can still reach the threshold (what has no positive part in
essential postings cannot). Shards are searched in rounds, each of more shards than
all before, and a round starts from the thresholds found so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.sources.shared import staged

SEED_TERMS = 8  # terms of largest bound whose sums pick the vectors that set the first threshold
QUERIES_AT_ONCE = 64  # queries whose essential postings are traversed together
ROUND_GROWTH = 8  # the first round searches one shard, each further one so many times the shards


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, vector): floor(scale * x) of each component as double, of usable rows.

    Rows without vec_id, and vectors that are null or hold null or non-finite
    components, are left out; identical rows count once.
    """
    finite = F.expr("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double")).alias("vector"),
        )
        .distinct()
    )


def top_scores(
    candidates: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = 8192, query_rows: int = 2048
) -> DataFrame:
    """The k best candidates of every query: query_id, rank, vec_id, score.

    Both tables are (vec_id, vector) with whole numbers. Score is the inner
    product, missing components count as zero; a candidate with the query's own
    vec_id is left out; ties go to the smaller vec_id. Queries with fewer
    candidates have fewer rows, empty tables give none. Scores are exact while
    the sums of products stay below 2**53.

    Candidates lie in shards and queries in blocks by hash, each shard meets each
    block in one bounded task; a shard hands out at most k rows per query. Rounds
    grow with the logarithm of the shards.
    """
    place = F.xxhash64("vec_id", "vector", F.lit(3))
    candidates = staged(candidates.select("vec_id", "vector", place.alias("place")), "search_candidates")
    queries = staged(queries.select("vec_id", "vector", place.alias("place")), "search_queries")
    shards = max(1, -(-candidates.count() // shard_rows))
    blocks = max(1, -(-queries.count() // query_rows))
    candidates = candidates.select("vec_id", "vector", F.pmod("place", F.lit(shards)).cast("int").alias("shard"))
    queries = queries.select("vec_id", "vector", F.pmod("place", F.lit(blocks)).cast("int").alias("block"))
    best, first, width = None, 0, 1
    while first < shards:
        last = min(shards, first + width)
        asked = queries.withColumn("floor", F.lit(None).cast("long"))
        if best is not None:
            floors = best.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
            asked = queries.join(floors, "vec_id", "left")
        found = _searched(candidates.where(F.col("shard").between(first, last - 1)), asked, (first, last), blocks, k)
        if best is not None:
            found = found.unionAll(best.drop("rank"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        best = staged(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best_scores")
        first, width = last, width * ROUND_GROWTH
    return best.select("query_id", "rank", "vec_id", "score")


def _searched(candidates: DataFrame, queries: DataFrame, shards: tuple[int, int], blocks: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): per query and shard the k best, less those below the query's ``floor``."""
    every = lambda low, high: F.explode(F.sequence(F.lit(low), F.lit(high - 1)))
    asks = F.lit(True).alias("query")
    cells = queries.select("vec_id", "vector", asks, "floor", every(*shards).alias("shard"), "block").unionAll(
        candidates.select("vec_id", "vector", F.lit(False), F.lit(None).cast("long"), "shard", every(0, blocks))
    )

    def search(rows: pa.Table) -> pa.Table:
        asks = rows.column("query").to_numpy()
        vectors = _matrix(rows.column("vector"))
        ids = rows.column("vec_id").to_numpy()
        floors = rows.column("floor").cast(pa.float64()).fill_null(-np.inf).to_numpy()
        found = list(Shard(ids[~asks], vectors[~asks]).best(ids[asks], vectors[asks], floors[asks], k))
        return pa.table(
            {
                "query_id": np.repeat(ids[asks], [len(f[0]) for f in found]),
                "vec_id": np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)]),
                "score": np.concatenate([f[1] for f in found] or [np.zeros(0)]).astype(np.int64),
            }
        )

    return cells.groupBy("shard", "block").applyInArrow(search, "query_id long, vec_id long, score long")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    lengths = np.diff(np.asarray(column.offsets)) if len(column) else np.zeros(0, int)
    flat = np.asarray(column.flatten(), dtype=np.float64)
    matrix = np.zeros((len(lengths), int(lengths.max(initial=0))))
    matrix[np.arange(matrix.shape[1]) < lengths[:, None]] = flat
    return matrix


class Shard:
    """Postings of some vectors: for each term, every vector's value and the extremes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.postings = np.ascontiguousarray(vectors.T)
        self.highest = vectors.max(axis=0, initial=-np.inf)
        self.lowest = vectors.min(axis=0, initial=np.inf)

    def best(self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query ids and scores of the k best that reach its floor, by score then id."""
        for low in range(0, len(queries), QUERIES_AT_ONCE):
            part = slice(low, low + QUERIES_AT_ONCE)
            if len(self.ids):
                yield from self._best(query_ids[part], queries[part], floors[part], k)
            else:
                yield from [(np.zeros(0, np.int64), np.zeros(0))] * len(queries[part])

    def _best(self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        bound = np.maximum(queries * self.highest, queries * self.lowest)
        terms = np.argsort(-bound, axis=1, kind="stable")
        rest = np.zeros((len(queries), terms.shape[1] + 1))  # bound of the terms from each one on
        rest[:, :-1] = np.cumsum(np.take_along_axis(bound, terms, 1)[:, ::-1], axis=1)[:, ::-1]
        thresholds = floors.copy()
        unknown = np.flatnonzero(np.isneginf(floors))
        if len(unknown):
            thresholds[unknown] = self._first_thresholds(query_ids[unknown], queries[unknown], terms[unknown], k)
        below = rest < thresholds[:, None]
        essential = np.where(below.any(axis=1), below.argmax(axis=1), terms.shape[1])
        score_of = self._traversed(queries, terms, essential)
        for i, query in enumerate(queries):
            done = essential[i]
            alive = np.flatnonzero(score_of[i] + rest[i, done] >= thresholds[i])
            alive = alive[self.ids[alive] != query_ids[i]]
            score = score_of[i, alive]
            while done < terms.shape[1] and len(alive):
                step = terms[i, done : done + 4]
                score = score + query[step] @ self.postings[np.ix_(step, alive)]
                done += len(step)
                competitive = score + rest[i, done] >= thresholds[i]
                alive, score = alive[competitive], score[competitive]
            yield self._ranked(alive, query, k)

    def _traversed(self, queries: np.ndarray, terms: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Scores of all vectors from the first ``n`` of each query's terms."""
        heads = np.zeros_like(queries)
        taken = np.arange(terms.shape[1]) < n[:, None]
        np.put_along_axis(heads, terms, np.take_along_axis(queries, terms, 1) * taken, axis=1)
        return heads @ self.postings

    def _first_thresholds(self, query_ids: np.ndarray, queries: np.ndarray, terms: np.ndarray, k: int) -> np.ndarray:
        """The k-th best score among vectors that do well in the first terms; none where there are fewer than k."""
        found = np.full(len(queries), -np.inf)
        scores = self._traversed(queries, terms, np.full(len(queries), SEED_TERMS))
        for i, score in enumerate(scores):
            others = np.flatnonzero(self.ids != query_ids[i])
            if len(others) >= k:
                seeds = others[np.argpartition(-score[others], min(4 * k, len(others)) - 1)[: 4 * k]]
                found[i] = np.sort(self.vectors[seeds] @ queries[i])[-k]
        return found

    def _ranked(self, rows: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        score = self.vectors[rows] @ query
        order = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows][order], score[order]
