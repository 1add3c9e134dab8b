"""The jobs' intermediate results for SQL users: views over the operators, and table functions over the views.

    found = views(params, spark.table("user_visit_action"), cities=cities, product_info=spark.table("product_info"))
    register(spark, found)
    spark.sql("SELECT * FROM top_products(3) WHERE area = '华东'")

Nothing is computed or stored here: a view is the operator's plan, so a query on it is
optimised as a whole, down to the columns and dates the log is read for.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.operators import actions as log
from clicktrail.operators import categories, products, sessions
from clicktrail.params import TaskParams

# name: (arguments, result columns, body over the views)
FUNCTIONS = {
    "top_products": (
        "places INT",
        "area STRING, area_level STRING, place INT, product_id BIGINT, city_infos STRING, click_count BIGINT, product_name STRING, product_status STRING",
        """SELECT area, area_level, place, product_id, city_infos, click_count, product_name, product_status
           FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS place FROM {area_product_full})
           WHERE place <= top_products.places""",
    ),
    "top_categories": (
        "places INT",
        "category_id BIGINT, click_count BIGINT, order_count BIGINT, pay_count BIGINT, place INT",
        """SELECT category_id, click_count, order_count, pay_count, place
           FROM (SELECT *, row_number() OVER (ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id) AS place FROM {category_activity})
           WHERE place <= top_categories.places""",
    ),
    "actions_of": (
        "session STRING",
        "user_id BIGINT, page_id BIGINT, action_ts TIMESTAMP, keyword STRING, category_id BIGINT, product_id BIGINT",
        """SELECT user_id, page_id, action_ts, keyword, category_id, product_id FROM {normalised_actions} WHERE session_id = actions_of.session""",
    ),
    "sessions_between": (
        "first TIMESTAMP, last TIMESTAMP",
        "session_id STRING, user_id BIGINT, visit_length BIGINT, step_length BIGINT, start_time STRING",
        """SELECT session_id, user_id, visit_length, step_length, start_time FROM {session_filtered}
           WHERE start_ts BETWEEN sessions_between.first AND sessions_between.last""",
    ),
}


def views(
    params: TaskParams,
    actions: DataFrame,
    users: DataFrame | None = None,
    product_info: DataFrame | None = None,
    cities: DataFrame | None = None,
    levels: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """The intermediate results by name, as far as their inputs are given; levels name the level of each area."""
    selected = log.normalised_actions(log.actions_in_range(actions, params))
    found = {"normalised_actions": selected, "session_summary": sessions.session_summary(selected, params)}
    if users is not None:
        kept = sessions.session_filtered(sessions.session_enriched(found["session_summary"], users), params)
        activity = categories.session_category_activity(categories.category_events(selected), kept)
        found |= {"session_filtered": kept, "category_activity": categories.category_activity(activity)}
    clicks = log.clicked_products(actions, params)
    if cities is not None:
        found["click_product_basic"] = products.click_product_basic(clicks, cities)
        found["area_product_clicks"] = products.area_product_clicks(products.city_product_clicks(clicks), cities)
        if product_info is not None:
            full = products.area_product_full(found["area_product_clicks"], product_info)
            found["area_product_full"] = full.withColumn("area_level", products.area_level(F.col("area"), levels or {}))
    return found


def register(spark: SparkSession, found: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Make ``views`` known to SQL, with the table functions whose views are there; returns all names.

    Views and functions last as long as the session; ``prefix`` comes before their
    names, where the catalog has tables of the same name.
    """
    for name, df in found.items():
        df.createOrReplaceTempView(prefix + name)
    names = [prefix + name for name in found]
    known = {name: prefix + name for name in found}
    for name, (arguments, columns, body) in FUNCTIONS.items():
        try:
            body = body.format_map(known)
        except KeyError:
            continue  # its view's inputs were not given
        body = body.replace(f"{name}.", f"{prefix}{name}.")
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({arguments}) RETURNS TABLE({columns}) RETURN {body}")
        names.append(prefix + name)
    return names
