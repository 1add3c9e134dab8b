"""Reading and changing packed ``field=value|field=value`` report columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _fields(packed: Column) -> Column:
    return F.split(packed, r"\|")


def _name(field: Column) -> Column:
    return F.substring_index(field, "=", 1)


def _value(field: Column) -> Column:
    """Text after the first ``=``; NULL when empty or without one."""
    return F.nullif(F.get(F.split(field, "=", 2), F.lit(1)), F.lit(""))


def kv_report_decode(reports: DataFrame, column: str) -> DataFrame:
    """One row per field: ``pos, field, value`` next to the report's other columns.

    Positions count from 1. A field that occurs twice keeps both rows; a NULL or
    empty report keeps one row with NULL position, field and value.
    """
    others = [name for name in reports.columns if name != column]
    fields = _fields(F.nullif(F.col(column), F.lit("")))
    return reports.select(*others, F.posexplode_outer(fields).alias("at", "item")).select(
        *others,
        (F.col("at") + 1).alias("pos"),
        _name(F.col("item")).alias("field"),
        _value(F.col("item")).alias("value"),
    )


def kv_value(packed: Column, field: str) -> Column:
    """Value of the first field of that name that has one, else NULL."""
    found = F.filter(
        _fields(packed), lambda item: (_name(item) == field) & _value(item).isNotNull()
    )
    return _value(F.get(found, F.lit(0)))


def kv_replaced(packed: Column, field: str, value: str) -> Column:
    """The packed text with the field's value replaced; an absent field is not added."""
    return F.array_join(
        F.transform(
            _fields(packed),
            lambda item: F.when(_name(item) == field, F.lit(f"{field}={value}")).otherwise(item),
        ),
        "|",
    )
