"""Stored partial aggregates against the summary of the whole log."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from clicktrail.operators import actions as log
from clicktrail.operators import history, sessions
from tests.rows import PARAMS, action, actions_of

DAYS = [f"2019-02-{day:02d}" for day in range(1, 8)]
ROWS = [
    action(f"s{i % 11}", i % 11, i, 1, f"{DAYS[i % 7]} {i % 24}:00:0{i % 10}", keyword=f"k{i % 5}" if i % 3 else "", click=i % 4 - 1, date=DAYS[i % 7])
    for i in range(300)
]
ODD = [action("odd", None, 900, time="no time", date=DAYS[2]), action(None, 3, 901, date=DAYS[3], keyword="k9")]


def files_of(folder):
    return {str(path.relative_to(folder)) for path in folder.rglob("*.parquet")}


def rows_of(df, columns):
    return sorted(map(repr, df.select(*columns).collect()))


@pytest.fixture
def folder(spark, tmp_path):
    history.store_dates(actions_of(spark, [r for r in ROWS + ODD if r[0] < DAYS[5]]), str(tmp_path))
    return tmp_path


def test_a_new_date_reads_and_writes_only_itself(spark, folder):
    before = files_of(folder)
    history.store_dates(actions_of(spark, [r for r in ROWS if r[0] >= DAYS[5]]), str(folder))
    assert before < files_of(folder)
    assert all(f"date={DAYS[5]}" in name or f"date={DAYS[6]}" in name for name in files_of(folder) - before)


def test_merged_summary_is_that_of_the_whole_log(spark, folder):
    history.store_dates(actions_of(spark, [r for r in ROWS if r[0] >= DAYS[5]]), str(folder))
    columns = ["session_id", "user_id", "start_ts", "end_ts", "step_length", "visit_length", "start_time", "keyword_match", "category_match"]
    params = replace(PARAMS, keywords=("k2", "k9"), category_ids=(1, 77))
    for start, end in ((DAYS[0], DAYS[6]), (DAYS[2], DAYS[4])):
        params = replace(params, start_date=start, end_date=end)
        whole = sessions.session_summary(log.actions_in_range(actions_of(spark, ROWS + ODD), params), params)
        partials, listed = (history.stored(spark, str(folder), name, params) for name in (history.SESSIONS, history.VALUES))
        merged = history.merged_summary(partials, listed, params)
        assert rows_of(merged, columns) == rows_of(whole, columns)
        lists = history.merged_values(listed).groupBy("session_id").agg(
            F.array_join(F.array_sort(F.collect_list(F.when(F.col("kind") == "keyword", F.col("value")))), ",").alias("k"),
        )
        expected = whole.select("session_id", F.array_join("search_keywords", ",").alias("k")).where("k <> ''")
        assert rows_of(lists.where("k <> ''"), ["session_id", "k"]) == rows_of(expected, ["session_id", "k"])


def test_a_date_stored_again_counts_once(spark, folder):
    corrected = [r for r in ROWS if r[0] == DAYS[1]][:5]
    history.store_dates(actions_of(spark, corrected), str(folder))
    history.store_dates(actions_of(spark, corrected), str(folder))
    stored = history.stored(spark, str(folder), history.SESSIONS, replace(PARAMS, start_date=DAYS[1], end_date=DAYS[1]))
    assert stored.agg(F.sum("step_length")).first()[0] == 5
    assert stored.inputFiles() and "date" in stored.columns
    everything = history.stored(spark, str(folder), history.SESSIONS, PARAMS).agg(F.sum("step_length")).first()[0]
    assert everything == sum(r[0] < DAYS[5] and r[0] != DAYS[1] for r in ROWS + ODD) + 5


def test_filters_need_values_and_empty_logs_are_fine(spark, tmp_path):
    history.store_dates(actions_of(spark, ROWS[:1]), str(tmp_path))
    history.store_dates(actions_of(spark, ROWS[:1]).limit(0), str(tmp_path))
    later = replace(PARAMS, start_date="2020-01-01", end_date="2020-01-02")
    partials = history.stored(spark, str(tmp_path), history.SESSIONS, later)
    assert history.merged_summary(partials).collect() == []
    with pytest.raises(ValueError, match="values"):
        history.merged_summary(partials, params=replace(PARAMS, keywords=("k",)))


def test_stored_dates_prune_the_scan(spark, folder):
    from tests.rows import plan_of

    plan = plan_of(history.merged_summary(history.stored(spark, str(folder), history.SESSIONS, replace(PARAMS, start_date=DAYS[1], end_date=DAYS[2]))))
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert DAYS[1] in filters and DAYS[2] in filters
