"""The city dimension that comes with the product report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clicktrail.schemas import CITIES


def city_dimension(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({city_id}L, '{name}', '{area}')" for city_id, name, area in CITIES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS city(city_id, city_name, area)")
