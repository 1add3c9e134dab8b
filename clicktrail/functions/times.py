"""Time expressions, as SQL text over a column name.

The results go into ``selectExpr`` and ``F.expr``.
"""

from __future__ import annotations


def action_timestamp(text: str) -> str:
    """Timestamp of ``yyyy-MM-dd H:mm:ss`` text; the hour may be one digit.

    Any other text gives NULL, also what a cast would take: a time without date,
    a year, an offset.
    """
    return f"try_to_timestamp({text}, 'yyyy-MM-dd H:mm:ss')"


def time_text(ts: str) -> str:
    return f"date_format({ts}, 'yyyy-MM-dd HH:mm:ss')"


def date_text(ts: str) -> str:
    return f"CAST(CAST({ts} AS DATE) AS STRING)"


def hour_text(ts: str) -> str:
    return f"lpad(CAST(hour({ts}) AS STRING), 2, '0')"


def date_hour(ts: str) -> str:
    return f"date_format({ts}, 'yyyy-MM-dd_HH')"


def date_key(ts: str) -> str:
    return f"date_format({ts}, 'yyyyMMdd')"


def date_of_key(key: str) -> str:
    return f"to_date({key}, 'yyyyMMdd')"


def yesterday_text(date: str) -> str:
    """The day before a ``yyyy-MM-dd`` text, NULL if it is none."""
    return f"CAST(date_sub(try_to_date({date}, 'yyyy-MM-dd'), 1) AS STRING)"


def minute_key(ts: str) -> str:
    return f"date_format({ts}, 'yyyyMMddHHmm')"


def seconds_between(start: str, end: str) -> str:
    return f"unix_timestamp({end}) - unix_timestamp({start})"
