"""Parameters of one analysis task."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, timedelta


def _items(value) -> tuple[str, ...]:
    if value is None:
        return ()
    if isinstance(value, str):
        value = value.split(",")
    return tuple(text for text in (str(item).strip() for item in value) if text)


def _number(value) -> int | None:
    return None if value is None or str(value).strip() == "" else int(value)


@dataclass(frozen=True)
class TaskParams:
    """Date range, session filters, page path and sampling settings.

    ``None`` or an empty tuple switches a filter off. The age filter needs
    both bounds. The date range is inclusive and always explicit.
    """

    start_date: str
    end_date: str
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[int, ...] = ()
    target_page_flow: tuple[int, ...] = ()
    sample_size: int = 100
    extra_per_hour: int = 0
    seed: str = "7"

    @classmethod
    def of_yesterday(cls, as_of: date, **settings) -> TaskParams:
        """The day before ``as_of``; the caller names the day, so a rerun repeats it."""
        day = (as_of - timedelta(days=1)).isoformat()
        return cls(start_date=day, end_date=day, **settings)

    @classmethod
    def from_mapping(cls, task: Mapping) -> TaskParams:
        """Build from the task's JSON names; lists may be comma-separated text.

        ``sampleSize``, ``extraPerHour`` and ``seed`` set the random sample.
        """
        sampling = {
            "sample_size": _number(task.get("sampleSize")),
            "extra_per_hour": _number(task.get("extraPerHour")),
            "seed": None if task.get("seed") is None else str(task["seed"]),
        }
        return cls(
            start_date=task["startDate"],
            end_date=task["endDate"],
            start_age=_number(task.get("startAge")),
            end_age=_number(task.get("endAge")),
            professionals=_items(task.get("professionals")),
            cities=_items(task.get("cities")),
            sex=task.get("sex") or None,
            keywords=_items(task.get("keywords")),
            category_ids=tuple(int(i) for i in _items(task.get("categoryIds"))),
            target_page_flow=tuple(int(i) for i in _items(task.get("targetPageFlow"))),
            **{name: value for name, value in sampling.items() if value is not None},
        )
