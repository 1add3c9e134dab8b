import os
import subprocess
import sys
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from clicktrail.functions import values
from clicktrail.operators import actions as log
from clicktrail.operators import sessions
from tests.rows import EDGE, PARAMS, action, actions_of, edge_users, log_of, users_of


ROOT = str(Path(__file__).resolve().parents[1])


def by_id(df):
    return {row.session_id: row for row in df.collect()}


def kept_ids(spark, rows, users, params):
    return set(by_id(sessions.filtered_sessions(actions_of(spark, rows), users, params)))


def test_date_range_is_inclusive(spark):
    rows = [action("s", 1, i, date=f"2019-02-0{i}") for i in range(1, 6)]
    found = log.actions_in_range(log_of(spark, rows), replace(PARAMS, start_date="2019-02-02", end_date="2019-02-04"))
    assert {row.date for row in found.collect()} == {"2019-02-02", "2019-02-03", "2019-02-04"}


def test_log_without_sequence_gets_a_repeatable_one(spark):
    plain = log_of(spark, EDGE).drop("action_seq")
    first = log.normalised_actions(plain).select("session_id", "action_seq").collect()
    again = log.normalised_actions(plain.repartition(3)).select("session_id", "action_seq").collect()
    assert sorted(first) == sorted(again)
    same_second = [row.action_seq for row in first if row.session_id == "A"]
    assert len(set(same_second)) == 3  # page 2 twice, at different times


def test_clicked_products(spark):
    rows = [action("s", 1, 1, product=5, city=3), action("s", 1, 2), action("s", 1, 3, product=None),
            action("s", 1, 4, product=6, date="2020-01-01")]
    assert [tuple(r) for r in log.clicked_products(log_of(spark, rows), PARAMS).collect()] == [(3, 5)]


def test_summary(spark):
    found = by_id(sessions.session_summary(actions_of(spark, EDGE)))
    a, b = found["A"], found["B"]
    assert (a.user_id, a.search_keywords, a.click_category_ids) == (1, ["hotpot", "new hotpot"], [1, 11])
    assert (a.visit_length, a.step_length, a.start_time) == (7, 4, "2019-02-01 09:59:58")
    assert (b.search_keywords, b.click_category_ids, b.visit_length, b.step_length) == ([], [], 0, 1)
    text = sessions.session_summary(actions_of(spark, EDGE)).withColumn(
        "search_keywords", F.expr(values.comma_text("search_keywords"))
    )
    assert by_id(text)["B"].search_keywords is None
    assert set(found) == {"A", "B", "C"}


def test_session_user_is_the_smallest(spark):
    rows = [action("s", 8, 1), action("s", 3, 2), action("s", 5, 3)]
    assert by_id(sessions.session_summary(actions_of(spark, rows)))["s"].user_id == 3


def test_unknown_users_drop(spark):
    summary = sessions.session_summary(actions_of(spark, EDGE))
    assert set(by_id(sessions.session_enriched(summary, edge_users(spark)))) == {"A", "B"}


def test_each_filter(spark):
    rows = [action(s, u, u, keyword=k, click=c) for s, u, k, c in
            [("a", 1, "tea", -1), ("b", 2, "green tea", 11), ("c", 3, None, 1), ("d", 4, "tea", 1)]]
    users = users_of(spark, (1, 20, "it", "rome", "male"), (2, 50, "law", "oslo", "female"),
                     (3, 51, "it", "oslo", "female"), (4, None, None, None, None))
    everything = replace(PARAMS, start_age=None, end_age=None)

    def kept(**conditions):
        return kept_ids(spark, rows, users, replace(everything, **conditions))

    assert kept() == {"a", "b", "c", "d"}
    assert kept(start_age=20, end_age=50) == {"a", "b"}
    assert kept(start_age=20) == {"a", "b", "c", "d"}
    assert kept(professionals=("it", "art")) == {"a", "c"}
    assert kept(cities=("oslo",)) == {"b", "c"}
    assert kept(sex="female") == {"b", "c"}
    assert kept(keywords=("tea", "milk")) == {"a", "d"}
    assert kept(category_ids=(1,)) == {"c", "d"}
    assert kept(category_ids=(-1,)) == set()
    assert kept(keywords=("tea",), category_ids=(1,), start_age=0, end_age=99) == set()


def test_interest_filters_drop_the_lists_from_the_plan(spark):
    params = replace(PARAMS, keywords=("tea",), category_ids=(1,))
    kept = sessions.filtered_sessions(actions_of(spark, EDGE), edge_users(spark), params)
    plan = sessions.session_aggr_stat(kept, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan


def test_buckets(spark):
    kept = sessions.filtered_sessions(actions_of(spark, EDGE), edge_users(spark), PARAMS)
    found = by_id(sessions.session_buckets(kept))
    assert (found["A"].visit_bucket, found["A"].step_bucket) == ("7s_9s", "4_6")
    assert (found["B"].visit_bucket, found["B"].step_bucket) == (None, "1_3")


@pytest.mark.parametrize("steps, bucket", [(30, "10_30"), (31, "30_60"), (60, "30_60"), (61, "60")])
def test_long_sessions_in_step_buckets(spark, steps, bucket):
    rows = [action("s", 1, i) for i in range(steps)]
    found = by_id(sessions.session_buckets(sessions.session_summary(actions_of(spark, rows))))
    assert found["s"].step_bucket == bucket


def test_aggr_stat(spark):
    kept = sessions.filtered_sessions(actions_of(spark, EDGE), edge_users(spark), PARAMS)
    row = sessions.session_aggr_stat(kept, "t").first().asDict()
    assert (row.pop("taskid"), row.pop("session_count")) == ("t", 2)
    halves = {"visit_length_7s_9s_ratio", "step_length_1_3_ratio", "step_length_4_6_ratio"}
    assert len(row) == 15
    assert row == {name: 0.5 if name in halves else 0.0 for name in row}


def test_shares_cover_all_sessions(spark):
    """Every session has a step bucket, and a visit bucket unless it took no time."""
    rows = [action(f"s{i % 97}", 1, i, time=f"2019-02-01 10:{i * 7 % 60:02d}:{i * 13 % 60:02d}") for i in range(300)]
    rows += [action(f"short{i}", 1, i) for i in range(20)]
    found = sessions.session_buckets(
        sessions.filtered_sessions(actions_of(spark, rows), edge_users(spark), PARAMS)
    ).collect()
    assert len(found) == 117 and all(r.step_bucket for r in found)
    assert all((r.visit_bucket is None) == (r.visit_length == 0) for r in found)
    assert sum(r.visit_length == 0 for r in found) >= 20


def test_aggr_stat_without_sessions(spark):
    params = replace(PARAMS, start_age=51, end_age=59)
    kept = sessions.filtered_sessions(actions_of(spark, EDGE), edge_users(spark), params)
    row = sessions.session_aggr_stat(kept, "t").first().asDict()
    assert row.pop("session_count") == 0
    assert set(row.values()) == {"t", None}


def test_aggr_stat_rounds_half_up(spark):
    rows = [action(f"s{i}", 1, i) for i in range(200)]
    rows += [action(f"s{i}", 1, 1000 + i, time="2019-02-01 10:00:02") for i in range(57)]
    kept = sessions.filtered_sessions(actions_of(spark, rows), edge_users(spark), PARAMS)
    assert sessions.session_aggr_stat(kept, "t").first().visit_length_1s_3s_ratio == 0.29


def test_detail(spark):
    actions = actions_of(spark, EDGE)
    kept = sessions.filtered_sessions(actions, edge_users(spark), PARAMS)
    found = sessions.session_detail(actions, kept, "t")
    assert found.columns == ["taskid", *sessions.DETAIL_COLUMNS]
    rows = {(row.sessionid, row.pageid, row.actionTime, row.clickCategoryId) for row in found.collect()}
    assert rows == {
        ("A", 1, "2019-02-01 9:59:58", -1), ("A", 2, "2019-02-01 10:00:01", -1),
        ("A", 3, "2019-02-01 10:00:01", 11), ("A", 2, "2019-02-01 10:00:05", 1),
        ("B", 1, "2019-02-01 09:00:00", -1),
    }
    assert found.where("sessionid = 'B'").first().orderCategoryIds == "7,7,3,"


def test_filter_on_a_summary_without_it_is_refused(spark):
    actions = actions_of(spark, EDGE)
    enriched = sessions.session_enriched(sessions.session_summary(actions), edge_users(spark))
    with pytest.raises(AnalysisException, match="keyword_match"):
        sessions.session_filtered(enriched, replace(PARAMS, keywords=("nobody asks",)))


REPEATED_TASK = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from clicktrail.operators import sessions

spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "3").getOrCreate())

def fail_first(batches):
    yield from batches
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("first attempt")

rows = spark.range(1000).selectExpr("concat('s', id) AS session_id", "id % 9 AS visit_length", "id % 70 AS step_length").repartition(5)
kept, counters = sessions.observed_sessions(rows)
kept.mapInArrow(fail_first, kept.schema).write.parquet(sys.argv[1])
found = sessions.observed_aggr_stat(spark, counters, "t").first()
assert found == sessions.session_aggr_stat(rows, "t").first() and found.session_count == 1000, found
print("counted once")
"""


def test_observed_counters_are_those_of_the_report(spark, tmp_path):
    rows = spark.range(500).selectExpr("concat('s', id) AS session_id", "id % 99 AS visit_length", "id % 70 AS step_length")
    for df in (rows, rows.limit(0)):
        kept, counters = sessions.observed_sessions(df.repartition(3))
        kept.write.mode("overwrite").parquet(str(tmp_path / "kept"))
        assert sessions.observed_aggr_stat(spark, counters, "t").collect() == sessions.session_aggr_stat(df, "t").collect()
        assert kept.columns == rows.columns


def test_a_repeated_task_counts_once(tmp_path):
    """Every task of the write fails once after its rows were counted."""
    script = tmp_path / "repeated.py"
    script.write_text(REPEATED_TASK)
    done = subprocess.run([sys.executable, script, tmp_path / "kept"], capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": ROOT})
    assert "counted once" in done.stdout, done.stderr[-2000:]
