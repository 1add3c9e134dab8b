"""Selecting and cleaning rows of the action log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.functions import times, values
from clicktrail.params import TaskParams


def actions_in_range(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Rows whose ``date`` lies in the task's inclusive range.

    ``date`` is compared as stored text, so the filter reaches the scan and
    prunes partitions of a log stored by date.
    """
    return actions.where(F.col("date").between(params.start_date, params.end_date))


def normalised_actions(actions: DataFrame) -> DataFrame:
    """The log with typed columns next to the stored ones.

    ``action_ts`` parses one-digit hours; ``keyword``, ``category_id`` and
    ``product_id`` are NULL where the log holds a blank or -1; the four id
    lists become arrays. ``action_seq`` orders actions of the same second; in a
    log without one a hash of page and user does, so the order is repeatable,
    needs no shuffle and reads no further columns. Columns nobody uses are pruned.
    """
    if "action_seq" not in actions.columns:
        actions = actions.withColumn("action_seq", F.xxhash64("page_id", "user_id"))
    return actions.selectExpr("*", f"{times.action_timestamp('action_time')} AS action_ts").selectExpr(
        "*",
        f"{times.date_hour('action_ts')} AS date_hour",
        f"{times.date_key('action_ts')} AS date_key",
        f"{times.minute_key('action_ts')} AS minute_key",
        f"{values.blank_to_null('search_keyword')} AS keyword",
        f"{values.absent_to_null('click_category_id')} AS category_id",
        f"{values.absent_to_null('click_product_id')} AS product_id",
        f"{values.id_list('order_category_ids')} AS order_categories",
        f"{values.id_list('order_product_ids')} AS order_products",
        f"{values.id_list('pay_category_ids')} AS pay_categories",
        f"{values.id_list('pay_product_ids')} AS pay_products",
    )


def clicked_products(actions: DataFrame, params: TaskParams) -> DataFrame:
    """``city_id, click_product_id`` of the product clicks in the date range."""
    return (
        actions_in_range(actions, params)
        .where(F.col("click_product_id").isNotNull() & (F.col("click_product_id") != -1))
        .select("city_id", "click_product_id")
    )
