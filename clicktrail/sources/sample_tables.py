"""The input tables expressed over the TPC-H-like test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEVELS = {"AFRICA": "A Level", "AMERICA": "A Level", "ASIA": "B Level", "EUROPE": "C Level"}


# The columns used here, declared so that opening a table starts no job.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_size INT",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def user_visit_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole action log from ``events``: one session per user and day."""
    return (
        read_table(spark, sf_dir, "events")
        .selectExpr(
            "*",
            "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
            "CAST(CAST(ts AS DATE) AS STRING) AS d",
            "(hour(ts) * 3600 + minute(ts) * 60 + second(ts)) div 30 AS off",
        )
        .selectExpr(
            "d AS date",
            "user_id",
            "concat(CAST(user_id AS STRING), '_', d) AS session_id",
            "CAST(k % 10 AS BIGINT) AS page_id",
            """concat(d, ' ', CAST(user_id % 24 AS STRING), ':',
                      lpad(CAST(off div 60 AS STRING), 2, '0'), ':',
                      lpad(CAST(off % 60 AS STRING), 2, '0')) AS action_time""",
            "CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % 12 AS STRING)) END AS search_keyword",
            "CAST(CASE WHEN event_type = 'click' THEN k ELSE -1 END AS BIGINT) AS click_category_id",
            """CAST(CASE WHEN event_type = 'click' THEN (event_id * 7) % 100 ELSE -1 END AS BIGINT)
               AS click_product_id""",
            """CASE WHEN event_type = 'purchase'
                    THEN concat(CAST(k AS STRING), ',', CAST((k + 17) % 100 AS STRING)) END
               AS order_category_ids""",
            """CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS STRING) END
               AS order_product_ids""",
            "CASE WHEN event_type = 'signup' THEN CAST(k AS STRING) END AS pay_category_ids",
            """CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS STRING) END
               AS pay_product_ids""",
            "CAST(event_id % 27 AS BIGINT) AS city_id",
            "event_id AS action_seq",
        )
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as users."""
    nation = read_table(spark, sf_dir, "nation")
    return (
        read_table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "c_custkey AS user_id",
            "concat('user', CAST(c_custkey AS STRING)) AS username",
            "c_name AS name",
            "CAST(c_custkey % 60 AS INT) AS age",
            "c_mktsegment AS professional",
            "n_name AS city",
            "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex",
        )
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "p_name AS product_name",
        """concat('{"product_status": ', CAST(p_size % 2 AS STRING), '}') AS extend_info""",
    )


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = read_table(spark, sf_dir, "region")
    return (
        read_table(spark, sf_dir, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr("CAST(n_nationkey AS BIGINT) AS city_id", "n_name AS city_name", "r_name AS area")
    )


def ad_click_lines(events: DataFrame) -> DataFrame:
    """Ad-click lines from batch or streaming ``events``; every 97th is no valid line."""
    line = F.concat_ws(
        " ",
        F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
        (F.col("user_id") % 10).cast("string"),
        (F.col("user_id") % 10).cast("string"),
        F.col("user_id").cast("string"),
        (F.col("event_id") % 20).cast("string"),
    )
    bad = F.concat(F.lit("bad line "), F.col("event_id").cast("string"))
    return events.select(F.when(F.col("event_id") % 97 == 0, bad).otherwise(line).alias("value"))
