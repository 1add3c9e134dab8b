"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.sources.shared import staged

HEX_DIGITS = 13  # of a hash: 52 bits, all a double holds exactly


def target_rates(docs: DataFrame, weights: Mapping[str, float] | None = None, total: float | None = None) -> DataFrame:
    """(source, rate): how often a document of each source is to be repeated on average.

    ``weights`` are shares by source, relative to each other; a source that is not
    named has weight 0, and without ``weights`` all sources have the same. ``total`` is the
    expected number of rows of the mixture, that of ``docs`` by default.
    """
    counts = staged(docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "source_counts")
    share = F.lit(1.0)
    if weights is not None:
        named = docs.sparkSession.createDataFrame(list(weights.items()) or [(None, 0.0)], "source string, weight double")
        counts = counts.join(named, "source", "left")
        share = F.coalesce("weight", F.lit(0.0))
    sums = counts.agg(F.sum(share).alias("weights"), F.sum("n").alias("rows")).first()
    if not sums["weights"]:
        return counts.select("source", F.lit(0.0).alias("rate"))
    wanted = float(sums["rows"] if total is None else total)
    return counts.select("source", (share / F.lit(float(sums["weights"])) * F.lit(wanted) / F.col("n")).alias("rate"))


def uniform(*parts):
    """A number in [0, 1) from a hash of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, HEX_DIGITS), 16, 10).cast("double") / float(16**HEX_DIGITS)


def poisson_steps(rates: DataFrame) -> DataFrame:
    """(source, first, cdf): P(count <= k) for k = first, first + 1, ... of each source of positive rate.

    The steps reach to where the rest is below 1e-16 and, from a rate of 1000 on, begin where the sum before is below
    1e-30, so their number grows with the root of the rate. Probabilities are summed in logarithms, which do not underflow.
    """
    rate, k = F.col("rate"), F.col("k").cast("double")
    reach = 12 * F.sqrt(rate)
    first = F.when(rate < 1000, F.lit(0).cast("long")).otherwise(F.floor(rate - reach))
    counts = rates.where("rate > 0").withColumn("first", first)
    counts = counts.withColumn("k", F.explode(F.sequence("first", (F.ceil(rate + reach) + 30).cast("long"))))
    # log P(count = k) by its distance from the rate and Stirling's series, whose next term is below 1e-20 from k = 600 on
    off = (k - rate) / rate
    far = -rate * ((1 + off) * F.log1p(off) - off) - F.log(2 * math.pi * k) / 2 - 1 / (12 * k) + 1 / (360 * k * k * k)
    step = F.when(F.col("k") > F.col("first"), F.log(rate) - F.log(k)).when(F.col("k") == 0, -rate).otherwise(far)
    order = Window.partitionBy("source").orderBy("k")
    counts = counts.withColumn("cdf", F.sum(F.exp(F.sum(step).over(order))).over(order))
    steps = F.array_sort(F.collect_list(F.struct("k", "cdf")))
    return counts.groupBy("source", "first").agg(F.transform(steps, lambda s: s["cdf"]).alias("cdf"))


def _count_up_to(steps: Column, bound: Column) -> Column:
    """How many of the rising ``steps`` are at most ``bound``, by halving."""

    def halved(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        return F.when(F.get(steps, middle) <= bound, F.struct((middle + 1).alias("low"), state["high"].alias("high"))).otherwise(
            F.struct(state["low"].alias("low"), middle.alias("high"))
        )

    halvings = F.sequence(F.lit(0), F.ceil(F.log2(F.size(steps) + 1)).cast("int"))
    return F.aggregate(halvings, F.struct(F.lit(0).alias("low"), F.size(steps).alias("high")), halved)["low"]


def mixed(docs: DataFrame, rates: DataFrame, seed: int = 0, shuffled: bool = True) -> DataFrame:
    """``docs`` (doc_id, source, ...) repeated at random, with replica, n_replicas and shuffle_key.

    A document's count is the inverse of its source's Poisson distribution at a
    number hashed from seed and doc_id, so any task gives the same mixture again.
    Its copies are numbered from 0 and spread over the whole output in the order
    of a hash of seed, doc_id and number; ``shuffled=False`` leaves out that step.

    A null source is a source, a null doc_id hashes like the text 'null'; rows that share
    a doc_id share their count. Sources without a rate give no rows. Columns of
    the names added are replaced, others stay; an empty table gives an empty result.
    """
    known = poisson_steps(rates).toDF("_source", "_first", "_cdf")
    kept = docs.drop("replica", "n_replicas", "shuffle_key")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    drawn = kept.withColumn("_u", uniform(F.lit(str(seed)), name)).join(known, F.col("source").eqNullSafe(F.col("_source")))
    count = (F.col("_first") + _count_up_to(F.col("_cdf"), F.col("_u"))).cast("int")
    copies = (
        drawn.withColumn("n_replicas", count)
        .where("n_replicas > 0")
        .withColumn("replica", F.explode(F.sequence(F.lit(0), F.col("n_replicas") - 1)))
        .withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(str(seed)), name, F.col("replica").cast("string")).cast("binary")))
        .select(*kept.columns, "replica", "n_replicas", "shuffle_key")
    )
    return copies.repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key") if shuffled else copies
