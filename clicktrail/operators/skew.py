"""Keeping one very large key from landing in one task.

Per-key counts are cheap: a narrow scan, combined before the shuffle. Their
``max_keys`` largest entries are the hot keys. At most ``max_keys`` rows can
come out, so they may be broadcast at any data size, and a key left out holds
less than one part in ``max_keys`` of all rows, so it may stay whole: the limit
bounds the list, it leaves no key untreated. Counts are exact and ties are
broken by key, so a recomputed task sees the same list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HOT_KEYS = 100_000
ROWS_PER_SPLIT = 1_000_000


def hot_keys(
    counts: DataFrame,
    key: str,
    rows: str,
    rows_per_split: int = ROWS_PER_SPLIT,
    max_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """``key, splits`` of the largest keys with more than ``rows_per_split`` rows.

    ``counts`` has one row per key. ``splits`` is how many parts a key needs so
    that a part holds about ``rows_per_split`` rows.
    """
    return (
        counts.where(F.col(rows) > rows_per_split)
        .orderBy(F.desc(rows), key)
        .limit(max_keys)
        .select(key, F.ceil(F.col(rows) / rows_per_split).cast("int").alias("splits"))
    )


def by_hotness(df: DataFrame, key: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of hot keys and all other rows. NULL is a key like any other."""
    listed = F.broadcast(hot.select(F.col(key).alias("hot_key")))
    is_hot = F.col(key).eqNullSafe(F.col("hot_key"))
    return df.join(listed, is_hot, "left_semi"), df.join(listed, is_hot, "left_anti")


def split_semi_join(facts: DataFrame, kept: DataFrame, key: str, spread: str, hot: DataFrame) -> DataFrame:
    """``facts`` rows whose ``key`` is in ``kept``, with hot keys spread over tasks.

    Rows of a hot key get a part number from a hash of ``spread`` and the input
    partition, so even copies of one row part ways; the partition number of a
    row is the same when its task is repeated. The key's entry in ``kept`` is
    repeated once per part. Other keys have the single part 0. The facts are
    scanned and shuffled once.
    """
    hot = F.broadcast(hot)
    parts = F.coalesce(F.col("splits"), F.lit(1))
    spread_hash = F.xxhash64(F.spark_partition_id(), F.col(spread))
    spread_facts = facts.join(hot, key, "left").withColumn(
        "part", F.pmod(spread_hash, parts.cast("bigint")).cast("int")
    )
    spread_kept = (
        kept.select(key)
        .join(hot, key, "left")
        .select(key, F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    )
    return spread_facts.join(spread_kept, [key, "part"], "left_semi").select(*facts.columns)
