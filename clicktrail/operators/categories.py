"""Category activity, the hottest categories and their most active sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.operators.sessions import detail_report

# What the log must hold for an action to be of a kind, and the categories it then has.
KINDS = {
    "click": ("click_category_id <> -1", "array_compact(array(category_id))"),
    "order": ("order_category_ids IS NOT NULL", "order_categories"),
    "pay": ("pay_category_ids IS NOT NULL", "pay_categories"),
}
TOP_CATEGORIES = 10
TOP_SESSIONS = 10


def category_events(actions: DataFrame, kinds=tuple(KINDS)) -> DataFrame:
    """``session_id, kind, category_id``: one row per category clicked, ordered or paid.

    A category listed twice in one order counts twice. Actions of other kinds are
    left out on the stored columns, so the scan can skip them.
    """
    wanted = " OR ".join(KINDS[kind][0] for kind in kinds)
    listed = ", ".join(f"'{kind}', {KINDS[kind][1]}" for kind in kinds)
    return (
        actions.where(wanted)
        .selectExpr("session_id", f"stack({len(kinds)}, {listed}) AS (kind, category_ids)")
        .selectExpr("session_id", "kind", "explode(category_ids) AS category_id")
    )


def session_category_activity(events: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Clicks, orders and payments per session and category, for the given sessions.

    Events are counted before they meet the session filter: the counts are
    combined ahead of the shuffle, so a session of any length enters the join
    with at most one row per category.
    """
    activity = events.groupBy("session_id", "category_id").agg(
        *(F.count_if(F.col("kind") == kind).alias(f"{kind}_count") for kind in KINDS)
    )
    if sessions is None:
        return activity
    return activity.join(sessions.select("session_id"), "session_id", "left_semi")


def category_universe(activity: DataFrame) -> DataFrame:
    """Every category clicked, ordered or paid."""
    return activity.select("category_id").distinct()


def category_activity(activity: DataFrame) -> DataFrame:
    """Clicks, orders and payments per category, 0 where it has none."""
    return activity.groupBy("category_id").agg(
        *(F.sum(f"{kind}_count").alias(f"{kind}_count") for kind in KINDS)
    )


def category_counts(activity: DataFrame, kind: str) -> DataFrame:
    """Count of one kind per category, for the categories that have it."""
    count = f"{kind}_count"
    return activity.where(F.col(count) > 0).groupBy("category_id").agg(F.sum(count).alias(count))


def category_click_counts(activity: DataFrame) -> DataFrame:
    return category_counts(activity, "click")


def category_order_counts(activity: DataFrame) -> DataFrame:
    return category_counts(activity, "order")


def category_pay_counts(activity: DataFrame) -> DataFrame:
    return category_counts(activity, "pay")


def top10_category(totals: DataFrame, task_id: str) -> DataFrame:
    """The ten categories with most clicks, then orders, then payments; ties by id."""
    return (
        totals.orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), "category_id")
        .limit(TOP_CATEGORIES)
        .select(
            F.lit(task_id).alias("taskid"),
            F.col("category_id").alias("categoryid"),
            F.col("click_count").alias("clickCount"),
            F.col("order_count").alias("orderCount"),
            F.col("pay_count").alias("payCount"),
        )
    )


def category_session_clicks(activity: DataFrame) -> DataFrame:
    """Clicks per category and session, where there are any."""
    return activity.where(F.col("click_count") > 0).select("category_id", "session_id", "click_count")


def top10_session(clicks: DataFrame, task_id: str) -> DataFrame:
    """The ten sessions with most clicks in each category; ties by session id.

    The fixed rank bound lets Spark cut each task's rows to ten per category
    before the shuffle, so a category clicked in very many sessions stays small.
    """
    place = F.row_number().over(
        Window.partitionBy("category_id").orderBy(F.desc("click_count"), "session_id")
    )
    return (
        clicks.withColumn("place", place)
        .where(F.col("place") <= TOP_SESSIONS)
        .select(
            F.lit(task_id).alias("taskid"),
            F.col("category_id").alias("categoryid"),
            F.col("session_id").alias("sessionid"),
            F.col("click_count").alias("clickCount"),
        )
    )


def clicks_in_top_categories(activity: DataFrame, top: DataFrame) -> DataFrame:
    """Clicks per category and session within the ten categories of ``top``, which are few enough to broadcast."""
    wanted = F.broadcast(top.select(F.col("categoryid").alias("category_id")))
    return category_session_clicks(activity).join(wanted, "category_id", "left_semi")


def top10_session_detail(top_sessions: DataFrame, actions: DataFrame, task_id: str) -> DataFrame:
    """Detail rows of the top sessions, once each however many categories they lead.

    There are at most ten sessions for each of ten categories to broadcast.
    """
    leaders = F.broadcast(top_sessions.select(F.col("sessionid").alias("session_id")).distinct())
    return detail_report(actions.join(leaders, "session_id", "left_semi"), task_id)
