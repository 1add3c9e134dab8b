"""Most clicked products per area."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.functions import values
from clicktrail.schemas import OTHER_LEVEL


def click_product_basic(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Each product click with its city's name and area; unknown cities drop.

    No hint: Spark broadcasts the cities when their size allows.
    """
    return clicks.join(cities, "city_id").select(
        "city_id", "city_name", "area", F.col("click_product_id").alias("product_id")
    )


def city_product_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks per city and product, combined before the shuffle."""
    return clicks.groupBy("city_id", F.col("click_product_id").alias("product_id")).agg(
        F.count(F.lit(1)).alias("city_clicks")
    )


def area_product_clicks(city_clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks per area and product, with the distinct ``id:name`` cities in id order.

    Starts from counts per city, so the join sees one row per city and product
    instead of every click, and a list gathers at most the cities of an area.
    """
    city = F.struct("city_id", "city_name")
    labels = "transform(array_sort(cities), c -> concat_ws(':', CAST(c.city_id AS STRING), c.city_name))"
    return (
        city_clicks.join(cities, "city_id")
        .groupBy("area", "product_id")
        .agg(F.sum("city_clicks").alias("click_count"), F.collect_set(city).alias("cities"))
        .withColumn("city_infos", F.expr(values.comma_text(labels)))
        .drop("cities")
    )


def area_product_full(area_clicks: DataFrame, products: DataFrame) -> DataFrame:
    """Adds product name and status; products without a description drop."""
    own = F.get_json_object("extend_info", "$.product_status") == "0"
    return area_clicks.join(products, "product_id").select(
        "area",
        "product_id",
        "click_count",
        "city_infos",
        "product_name",
        F.when(own, "Self").otherwise("Third Party").alias("product_status"),
    )


def area_level(area: Column, levels: Mapping[str, str]) -> Column:
    """Level of an area from a mapping; areas outside it get the last level."""
    level = F.lit(OTHER_LEVEL)
    for name, value in levels.items():
        level = F.when(area == name, F.lit(value)).otherwise(level)
    return level


def area_top3_product(
    area_products: DataFrame, levels: Mapping[str, str], task_id: str, k: int = 3
) -> DataFrame:
    """The ``k`` most clicked products of each area; ties by product id.

    The fixed rank bound is applied in each task before the shuffle by area.
    """
    place = F.row_number().over(Window.partitionBy("area").orderBy(F.desc("click_count"), "product_id"))
    return (
        area_products.withColumn("place", place)
        .where(F.col("place") <= k)
        .select(
            F.lit(task_id).alias("taskid"),
            "area",
            area_level(F.col("area"), levels).alias("areaLevel"),
            F.col("product_id").alias("productid"),
            F.col("city_infos").alias("cityInfos"),
            F.col("click_count").alias("clickCount"),
            F.col("product_name").alias("productName"),
            F.col("product_status").alias("productStatus"),
        )
    )
