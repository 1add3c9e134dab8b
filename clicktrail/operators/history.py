"""Session summaries kept by date: partial aggregates are stored once a day and merged for any range of dates.

Two tables below one folder, both stored by date. ``sessions`` has one row per date and session, of
constant size. ``values`` has one row per date, session and keyword or category, so a
session of any length makes more rows, never a longer one. A new date is
computed from its own actions alone, whether its sessions began earlier or not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.operators.sessions import with_lengths
from clicktrail.params import TaskParams
from clicktrail.sources.reports import table_overwrite

SESSIONS, VALUES = "sessions", "values"
SCHEMAS = {
    SESSIONS: "session_id STRING, user_id BIGINT, start_ts TIMESTAMP, end_ts TIMESTAMP, step_length BIGINT, date STRING",
    VALUES: "session_id STRING, kind STRING, value STRING, date STRING",
}


def session_partials(actions: DataFrame) -> DataFrame:
    """What merges of a session, per date of its normalised actions: smallest user, first and last time, actions."""
    return actions.groupBy("date", "session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("action_ts").alias("start_ts"),
        F.max("action_ts").alias("end_ts"),
        F.count(F.lit(1)).alias("step_length"),
    )


def session_values(actions: DataFrame) -> DataFrame:
    """``date, session_id, kind, value``: each keyword and clicked category of a session, once per date."""
    listed = actions.selectExpr(
        "date", "session_id", "stack(2, 'keyword', keyword, 'category', CAST(category_id AS STRING)) AS (kind, value)"
    )
    return listed.where("value IS NOT NULL").distinct()


def store_dates(actions: DataFrame, folder: str) -> None:
    """Store the partial aggregates of the dates in ``actions``.

    They replace those stored for the same dates before, other dates stay as they
    are and are not read; so a date may be stored again after its log was
    corrected or the run failed. A date without actions replaces nothing.
    """
    for name, part in ((SESSIONS, session_partials(actions)), (VALUES, session_values(actions))):
        table_overwrite(part, f"{folder}/{name}", "date", keep_others=True)


def stored(spark: SparkSession, folder: str, name: str, params: TaskParams) -> DataFrame:
    """One of the two tables within the task's dates; other dates' files are not opened."""
    table = spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}")
    return table.where(F.col("date").between(params.start_date, params.end_date))


def merged_values(values: DataFrame) -> DataFrame:
    """``session_id, kind, value``: the keywords and categories of whole sessions, a row each."""
    return values.select("session_id", "kind", "value").distinct()


def merged_summary(partials: DataFrame, values: DataFrame | None = None, params: TaskParams | None = None) -> DataFrame:
    """``session_summary`` of the stored dates, without lists; with ``params`` its filter flags, which need ``values``.

    Partial aggregates combine before the shuffle like the actions they stand for. The flags
    come from the wanted values alone: the filter on them reaches the scan.
    """
    summary = partials.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.sum("step_length").alias("step_length"),
    )
    for flag, kind, wanted in _wanted(params):
        if values is None:
            raise ValueError("keyword and category filters need the stored values")
        having = values.where((F.col("kind") == kind) & F.col("value").isin(*wanted))
        having = having.select(F.col("session_id").alias("having_id")).distinct().withColumn(flag, F.lit(True))
        same = F.col("session_id").eqNullSafe(F.col("having_id"))  # actions without session make one session
        summary = summary.join(having, same, "left").drop("having_id").withColumn(flag, F.coalesce(flag, F.lit(False)))
    return with_lengths(summary)


def _wanted(params: TaskParams | None) -> list[tuple[str, str, list[str]]]:
    found = []
    if params and params.keywords:
        found.append(("keyword_match", "keyword", list(params.keywords)))
    if params and params.category_ids:
        found.append(("category_match", "category", [str(i) for i in params.category_ids]))
    return found

