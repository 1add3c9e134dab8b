"""Run one of the report jobs on catalog tables.

    spark-submit clicktrail/plans/run.py session --params '{"startDate": "2019-02-01", ...}' \\
        --format jdbc --option url=jdbc:... --option user=... --option password=...

Reads ``user_visit_action``, ``user_info``, ``product_info`` and, where the
catalog has one, ``city_info``; appends to report tables of the usual names.
With a file format, ``--target`` is the folder that holds them. With ``--once`` a
task that is run again under its ``--task-id`` leaves one copy of its reports. ``stream``
appends decoded ad-click lines to the table at ``--target`` until its source has
no more, or, with ``--every``, until it is stopped. Times are taken as UTC.
"""

from __future__ import annotations

import argparse
import json
import sys
import uuid
from collections.abc import Sequence
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from clicktrail.operators.skew import ROWS_PER_SPLIT  # noqa: E402
from clicktrail.params import TaskParams  # noqa: E402
from clicktrail.plans import jobs  # noqa: E402
from clicktrail.schemas import AREA_LEVELS  # noqa: E402
from clicktrail.sources.dimensions import city_dimension  # noqa: E402
from clicktrail.sources.reports import report_append  # noqa: E402
from clicktrail.streaming import ad_clicks  # noqa: E402


def _save(name: str, report: DataFrame, target: str | None, format: str, once_per: str | None, options: dict) -> None:
    report_append(report, f"{target}/{name}" if target else name, format, once_per, **options)


def run(spark: SparkSession, arguments: Sequence[str]) -> str:
    """Run the job the arguments describe; returns the task id of its reports."""
    parser = argparse.ArgumentParser(description="Run a click-stream report job.")
    parser.add_argument("job", choices=["session", "page", "product", "stream"])
    parser.add_argument("--params", default="{}", help="task parameters as JSON")
    parser.add_argument("--levels", help="level of each area as JSON, for a city table of its own")
    parser.add_argument("--rows-per-split", type=int, default=ROWS_PER_SPLIT, help="actions of a session one task sorts")
    parser.add_argument("--source", default="kafka", help="source format of the stream; its settings are --option")
    parser.add_argument("--checkpoint", help="folder of the stream's progress")
    parser.add_argument("--every", help="how often the running stream starts a batch, as in '5 seconds'")
    parser.add_argument("--task-id", default=uuid.uuid4().hex)
    parser.add_argument("--format", default="table", help="table, jdbc or a file format")
    parser.add_argument("--target", help="folder of the reports, for file formats")
    parser.add_argument("--once", action="store_true", help="a task run again replaces its reports; tables are stored by task")
    parser.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")
    chosen = parser.parse_args(arguments)

    spark.conf.set("spark.sql.session.timeZone", "UTC")  # a clock change must not change a visit's length
    options = dict(option.split("=", 1) for option in chosen.option)
    if chosen.job == "stream":
        if not (chosen.target and chosen.checkpoint):
            parser.error("a stream needs --target and --checkpoint")
        lines = ad_clicks.ad_click_source(spark, chosen.source, **options)
        trigger = {"processingTime": chosen.every} if chosen.every else {}
        ad_clicks.ad_click_stream(lines, chosen.target, chosen.checkpoint, **trigger).awaitTermination()
        return chosen.task_id
    params = TaskParams.from_mapping(json.loads(chosen.params))
    save = partial(_save, target=chosen.target, format=chosen.format, once_per="taskid" if chosen.once else None, options=options)
    actions = spark.table("user_visit_action")
    if chosen.job == "session":
        jobs.session_job(actions, spark.table("user_info"), params, chosen.task_id, save)
    elif chosen.job == "page":
        jobs.page_job(actions, params, chosen.task_id, save, chosen.rows_per_split)
    else:
        known = spark.catalog.tableExists("city_info")
        cities = spark.table("city_info") if known else city_dimension(spark)
        products = spark.table("product_info")
        levels = json.loads(chosen.levels) if chosen.levels else AREA_LEVELS
        jobs.product_job(actions, cities, products, levels, params, chosen.task_id, save)
    return chosen.task_id


if __name__ == "__main__":
    run(SparkSession.builder.appName("clicktrail").getOrCreate(), sys.argv[1:])
