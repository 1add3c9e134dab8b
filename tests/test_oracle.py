"""Every registered query against its DuckDB SQL, and rules all plans keep."""

import inspect
import re
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from clicktrail.plans.queries import QUERIES
from oracle import ORACLE
from tests.rows import plan_of

SF_DIR = Path("/root/testdata/sf0.001")
NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    """A whole number that pandas made a float because of NULLs is a whole number."""
    return int(value) if isinstance(value, float) and value.is_integer() else value


def rows_of(frame, columns):
    rows = frame[columns].astype(object).itertuples(index=False)
    return sorted((tuple(None if pd.isna(x) else str(plain(x)) for x in row) for row in rows), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    found = entry.queries()[name](spark, str(SF_DIR)).toPandas()
    expected = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows_of(found, sorted(found.columns)) == rows_of(expected, sorted(found.columns))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and ORACLE.items() <= entry.oracle_sql().items()


def test_range_is_cut_by_the_operator(spark, duck, monkeypatch):
    from clicktrail.operators import actions

    monkeypatch.setattr(actions, "actions_in_range", lambda log, params: log)
    for name in ("actions_in_range", "clicked_products"):
        expected = len(duck.execute(ORACLE[name]).fetchall())
        assert QUERIES[name](spark, str(SF_DIR)).count() > expected


def test_flagship(spark):
    assert entry.entry(spark).count() == 1


@pytest.mark.parametrize("name", [n for n in NAMES if not re.search("append|overwrite|stream", n)])
def test_plans_have_no_python_and_no_nested_loops(spark, name):
    plan = plan_of(entry.queries()[name](spark, str(SF_DIR)))
    for operator in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in plan


def test_package_has_no_rdd_udf_or_collect():
    package = Path(inspect.getfile(entry)).parent / "clicktrail"
    for file in package.rglob("*.py"):
        if "llm" in file.parts:
            continue  # rules of its own
        assert not re.search(r"\.rdd\b|\budf\(|\.collect\(\)|toPandas|localCheckpoint|mkdtemp", file.read_text()), file
