"""Session summary, user attributes, filters and the length report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clicktrail.functions import times, values
from clicktrail.operators.skew import ROWS_PER_SPLIT, hot_keys, split_semi_join
from clicktrail.params import TaskParams
from clicktrail.schemas import STEP_BUCKETS, VISIT_BUCKETS
from clicktrail.sources.shared import staged

# Columns of the detail report and the log columns they show.
DETAIL_COLUMNS = {
    "userid": "user_id",
    "sessionid": "session_id",
    "pageid": "page_id",
    "actionTime": "action_time",
    "searchKeyword": "search_keyword",
    "clickCategoryId": "click_category_id",
    "clickProductId": "click_product_id",
    "orderCategoryIds": "order_category_ids",
    "orderProductIds": "order_product_ids",
    "payCategoryIds": "pay_category_ids",
    "payProductIds": "pay_product_ids",
}


def _any_in(column: str, wanted) -> Column:
    """Aggregate: does any row of the group hold one of the wanted values?"""
    return F.coalesce(F.bool_or(F.col(column).isin(*wanted)), F.lit(False))


def session_summary(actions: DataFrame, params: TaskParams | None = None) -> DataFrame:
    """One row per session of normalised actions.

    Keyword and category lists are exact distinct values, sorted; each task
    reduces a session's rows to them before the shuffle. Whether a session meets
    the task's keyword and category filters is kept as flags of constant size,
    present only for the filters ``params`` has, so filtering never needs the lists: a plan that does not ask for them
    drops them and stays a plain hash aggregate.
    A session's user is its smallest user id.
    """
    flags = []
    if params and params.keywords:
        flags.append(_any_in("keyword", params.keywords).alias("keyword_match"))
    if params and params.category_ids:
        flags.append(_any_in("category_id", params.category_ids).alias("category_match"))
    return with_lengths(
        actions.groupBy("session_id").agg(
            F.min("user_id").alias("user_id"),
            F.array_sort(F.collect_set("keyword")).alias("search_keywords"),
            F.array_sort(F.collect_set("category_id")).alias("click_category_ids"),
            *flags,
            F.min("action_ts").alias("start_ts"),
            F.max("action_ts").alias("end_ts"),
            F.count(F.lit(1)).alias("step_length"),
        )
    )


def with_lengths(sessions: DataFrame) -> DataFrame:
    """Adds the visit's length in seconds and its start as text."""
    return sessions.selectExpr(
        "*",
        f"{times.seconds_between('start_ts', 'end_ts')} AS visit_length",
        f"{times.time_text('start_ts')} AS start_time",
    )


def session_enriched(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions with their user's attributes; sessions of unknown users drop.

    No hint: Spark broadcasts the users when their size allows. Otherwise both
    sides are shuffled by user right before the join, which lets adaptive
    execution split the partition of a user with very many sessions.
    """
    return sessions.join(users.select("user_id", "age", "professional", "city", "sex"), "user_id")


def session_filtered(enriched: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions meeting every condition of the task; a NULL attribute meets none.

    ``enriched`` must come from a summary made with the same ``params``: one made
    without a filter lacks its flag, and Spark then refuses the query.
    """
    if params.start_age is not None and params.end_age is not None:
        enriched = enriched.where(F.col("age").between(params.start_age, params.end_age))
    if params.professionals:
        enriched = enriched.where(F.col("professional").isin(*params.professionals))
    if params.cities:
        enriched = enriched.where(F.col("city").isin(*params.cities))
    if params.sex:
        enriched = enriched.where(F.col("sex") == params.sex)
    if params.keywords:
        enriched = enriched.where("keyword_match")
    if params.category_ids:
        enriched = enriched.where("category_match")
    return enriched


def filtered_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Summary, user attributes and filter in one step, from normalised actions."""
    return session_filtered(session_enriched(session_summary(actions, params), users), params)


def session_buckets(sessions: DataFrame) -> DataFrame:
    """Adds ``visit_bucket`` and ``step_bucket``; a visit of zero seconds has no bucket."""
    return sessions.selectExpr(
        "*",
        f"{values.bucket_label('visit_length', VISIT_BUCKETS)} AS visit_bucket",
        f"{values.bucket_label('step_length', STEP_BUCKETS)} AS step_bucket",
    )


def session_aggr_stat(sessions: DataFrame, task_id: str) -> DataFrame:
    """One row: number of sessions and the share of each bucket.

    No sessions at all give a count of 0 and NULL shares.
    """
    return _shares(session_buckets(sessions).agg(*_counters()), task_id)


def _counted_buckets() -> dict[str, tuple[str, str]]:
    counted = {f"visit_length_{label}": ("visit_bucket", label) for label, _, _ in VISIT_BUCKETS}
    return counted | {f"step_length_{label}": ("step_bucket", label) for label, _, _ in STEP_BUCKETS}


def _counters() -> list[Column]:
    in_bucket = (F.expr(f"count_if({column} = '{label}') AS {name}") for name, (column, label) in _counted_buckets().items())
    return [F.count(F.lit(1)).alias("session_count"), *in_bucket]


def _shares(counted: DataFrame, task_id: str) -> DataFrame:
    return counted.select(
        F.lit(task_id).alias("taskid"),
        "session_count",
        *(F.expr(f"{values.ratio(name, 'session_count')} AS {name}_ratio") for name in _counted_buckets()),
    )


def observed_sessions(sessions: DataFrame) -> tuple[DataFrame, Observation]:
    """The sessions, and the counters of ``session_aggr_stat`` that fill while they are written.

    Write the sessions directly, without a shuffle in between: Spark then takes the
    counts of each partition's one committed task, so a task that is repeated
    does not count twice. The counters are there after the first action.
    """
    counters = Observation()
    counted = session_buckets(sessions).observe(counters, *_counters())
    return counted.drop("visit_bucket", "step_bucket"), counters


def observed_aggr_stat(spark: SparkSession, counters: Observation, task_id: str) -> DataFrame:
    """``session_aggr_stat`` from counters, without reading the sessions again."""
    counts = counters.get
    return _shares(spark.range(1).select(*(F.lit(counts[name]).alias(name) for name in ("session_count", *_counted_buckets()))), task_id)


def hot_sessions(sessions: DataFrame, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """The sessions too long for one task, from any table with ``session_id, step_length``."""
    return hot_keys(sessions, "session_id", "step_length", rows_per_split)


def session_actions(actions: DataFrame, sessions: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Actions of the given sessions; long sessions are split over tasks."""
    if hot is None:
        hot = staged(hot_sessions(session_summary(actions)), "hot_sessions")
    return split_semi_join(actions, sessions, "session_id", "action_seq", hot)


def detail_report(actions: DataFrame, task_id: str) -> DataFrame:
    """Actions in the shape of the detail report, with the values as stored."""
    return actions.select(
        F.lit(task_id).alias("taskid"),
        *(F.expr(f"{column} AS {name}") for name, column in DETAIL_COLUMNS.items()),
    )


def session_detail(
    actions: DataFrame, sessions: DataFrame, task_id: str, hot: DataFrame | None = None
) -> DataFrame:
    """Detail rows of every session that passed the filter."""
    return detail_report(session_actions(actions, sessions, hot), task_id)
