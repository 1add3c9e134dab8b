"""Repeatable random sample of sessions, stratified by day and hour."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.functions import times, values
from clicktrail.operators.sessions import detail_report, session_summary
from clicktrail.params import TaskParams

CELL = ["start_date", "start_hour"]
BIN_DIGITS = 3  # hexadecimal digits: 4096 bins of an hour's sessions


def _with_cell(sessions: DataFrame) -> DataFrame:
    return sessions.selectExpr(
        "*",
        f"{times.date_text('start_ts')} AS start_date",
        f"{times.hour_text('start_ts')} AS start_hour",
    )


def session_hourly_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per start date and hour, with the day's total."""
    return _with_day_total(_with_cell(sessions).groupBy(*CELL).agg(F.count(F.lit(1)).alias("session_count")))


def _with_day_total(hourly: DataFrame) -> DataFrame:
    return hourly.withColumn("day_session_count", F.sum("session_count").over(Window.partitionBy("start_date")))


def session_sample_quota(hourly: DataFrame, params: TaskParams) -> DataFrame:
    """How many sessions to draw in each date and hour.

    The sample size is split evenly over the days, then over a day's hours in
    proportion to their sessions, in whole numbers. ``extra_per_hour`` adds that
    many to each hour; a quota never exceeds the hour's sessions. Sessions
    without a readable time have quota 0.
    The unpartitioned window sees one row per date and hour, nothing else.
    """
    return hourly.withColumn("days", _days()).withColumn("quota", _quota(params)).drop("days")


def _days() -> Column:
    return F.size(F.collect_set("start_date").over(Window.partitionBy()))


def _quota(params: TaskParams) -> Column:
    share = f"session_count * ({params.sample_size} div nullif(days, 0)) div day_session_count"
    return F.expr(f"if(start_date IS NULL, 0L, least(session_count, {share} + {params.extra_per_hour}))")


def session_sample(sessions: DataFrame, params: TaskParams) -> DataFrame:
    """``session_id, start_time`` of the drawn sessions.

    Sessions of an hour are drawn in the order of a hash of seed and id, so the
    draw does not depend on partitioning or retries. One histogram of the hour's hashes, by their first
    ``BIN_DIGITS`` digits, says all that is needed: its total is the hour's count, from which the quotas
    follow, and its running sum how many of each bin are drawn. Histograms of tasks add up before
    the shuffle and have at most a fixed number of bins per hour. Only the bins that give something are
    joined back and ranked, so no task ranks a whole hour. Sessions without a readable time are never
    drawn.
    """
    keyed = _with_cell(sessions).withColumn("draw_key", F.md5(F.concat(F.lit(params.seed), F.col("session_id"))))
    keyed = keyed.select("session_id", "start_time", *CELL, "draw_key", F.substring("draw_key", 1, BIN_DIGITS).alias("bin"))
    counts = keyed.groupBy(*CELL, "bin").agg(F.count(F.lit(1)).alias("in_bin"))
    histogram = F.array_sort(F.collect_list(F.struct("bin", "in_bin"))).alias("histogram")
    hourly = counts.groupBy(*CELL).agg(F.sum("in_bin").alias("session_count"), histogram)
    # the window over all hours comes first: in its one partition the window by day needs no further shuffle
    quota = _with_day_total(hourly.withColumn("days", _days())).withColumn("quota", _quota(params))
    # each bin's sessions that are drawn: what the quota leaves after the bins before it
    given = "least(b.in_bin, greatest(0L, quota - aggregate(slice(histogram, 1, i), 0L, (n, x) -> n + x.in_bin)))"
    bins = quota.where("quota > 0").selectExpr(
        *CELL, f"inline(filter(transform(histogram, (b, i) -> named_struct('bin', b.bin, 'take', {given})), b -> b.take > 0))"
    )
    order = Window.partitionBy(*CELL, "bin").orderBy("draw_key", "session_id")
    # null-safe, as a plain comparison adds filters to one of the two uses of the sessions, which are then computed twice
    same = reduce(and_, (F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in (*CELL, "bin")))
    bins = bins.select("take", *(F.col(name).alias(f"of_{name}") for name in (*CELL, "bin")))
    giving = keyed.join(bins, same).withColumn("draw", F.row_number().over(order))
    return giving.where(F.col("draw") <= F.col("take")).select("session_id", "start_time")


def _drawn_actions(sample: DataFrame, actions: DataFrame) -> DataFrame:
    """Actions of the drawn sessions.

    No hint: a small sample is broadcast by Spark, otherwise both sides are
    shuffled right before the join and adaptive execution splits a long session. The comparison, true for
    every id, tells Spark that the drawn sessions are a selection: it then builds a Bloom filter of them, which drops
    other sessions' actions of a large log before the shuffle.
    """
    drawn = sample.where(F.col("session_id") >= "").select("session_id")
    return actions.join(drawn, "session_id", "left_semi")


def session_random_extract(
    sample: DataFrame, actions: DataFrame, params: TaskParams, task_id: str
) -> DataFrame:
    """Report of the drawn sessions with their keywords and clicked categories.

    The lists are gathered for the drawn sessions only.
    """
    return session_summary(_drawn_actions(sample, actions)).select(
        F.lit(task_id).alias("taskid"),
        F.col("session_id").alias("sessionid"),
        F.col("start_time").alias("startTime"),
        F.expr(f"{values.comma_text('search_keywords')} AS searchKeywords"),
        F.expr(f"{values.comma_text('click_category_ids')} AS clickCategoryIds"),
    )


def session_random_detail(
    sample: DataFrame, actions: DataFrame, params: TaskParams, task_id: str
) -> DataFrame:
    """Detail rows of the drawn sessions."""
    return detail_report(_drawn_actions(sample, actions), task_id)
