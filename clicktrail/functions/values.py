"""Missing values, id lists, ratios and buckets, as SQL text over column names.

The results go into ``selectExpr`` and ``F.expr``.
"""

from __future__ import annotations


def blank_to_null(text: str) -> str:
    return f"nullif({text}, '')"


def absent_to_null(number: str) -> str:
    """-1 marks an absent id."""
    return f"nullif({number}, -1L)"


def id_list(text: str) -> str:
    """Ids of a comma list as ``array<bigint>``; duplicates stay, gaps and non-numbers go."""
    return f"array_compact(transform(split({text}, ','), item -> try_cast(item AS BIGINT)))"


def comma_text(items: str) -> str:
    """Array as comma text, NULL when the array is empty."""
    return f"nullif(array_join({items}, ','), '')"


def ratio(part: str, whole: str) -> str:
    """``part / whole`` to two decimals, half up, in exact integer steps.

    NULL when ``whole`` is zero.
    """
    return f"((200 * {part} + {whole}) div (2 * nullif({whole}, 0L))) / 100.0D"


def bucket_label(value: str, buckets) -> str:
    """Label of the bucket holding ``value``; NULL outside all buckets."""
    cases = " ".join(
        f"WHEN {value} >= {low} THEN '{name}'"
        if high is None
        else f"WHEN {value} BETWEEN {low} AND {high} THEN '{name}'"
        for name, low, high in buckets
    )
    return f"CASE {cases} END"
