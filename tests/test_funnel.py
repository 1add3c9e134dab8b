import random
from collections import Counter
from dataclasses import replace

import pytest

from clicktrail.operators import funnel, packed
from clicktrail.operators.sessions import hot_sessions, session_summary
from tests.rows import EDGE, action, actions_of


def conversion_of(spark, rows, path):
    steps = funnel.session_steps(actions_of(spark, rows))
    return [tuple(r) for r in funnel.page_conversion(steps, path).orderBy("pos").collect()]


def random_rows(n, seed, same_time=False, hot="hot"):
    """One session holds a third of the rows; times repeat, rows come in no order."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        session = hot if rng.random() < 1 / 3 else f"s{rng.randint(0, 30)}"
        time = "2019-02-01 9:00:00" if same_time else f"2019-02-01 {rng.randint(0, 23)}:{rng.randint(10, 12)}:30"
        rows.append(action(session, 1, i, rng.randint(0, 4), time))
    rng.shuffle(rows)
    return rows


def expected_steps(rows):
    by_session = {}
    for row in rows:
        hour, minute, second = map(int, row[4].split(" ")[1].split(":"))
        by_session.setdefault(row[2], []).append(((hour, minute, second), row[13], row[3]))
    steps = Counter()
    for session, visits in by_session.items():
        pages = [page for _, _, page in sorted(visits)] + [None]
        steps.update((session, a, b) for a, b in zip(pages, pages[1:]))
    return steps


def test_target_pairs(spark):
    found = funnel.target_page_pairs(spark, (3, 5, 2)).collect()
    assert [tuple(r) for r in found] == [(1, 3, 5, "3_5"), (2, 5, 2, "5_2")]


def test_pairs_of_the_edge_rows(spark):
    steps = funnel.session_steps(actions_of(spark, EDGE))
    pairs = funnel.session_page_pairs(steps).where("session_id = 'A'").collect()
    assert sorted(r.pair for r in pairs) == ["1_2", "2_3", "3_2"]
    assert funnel.session_page_pairs(steps).count() == len(EDGE) - 3


@pytest.mark.parametrize("same_time", [False, True])
@pytest.mark.parametrize("slices", [2, 7, 40])
def test_hot_session_in_slices_matches_brute_force(spark, slices, same_time):
    rows = random_rows(400, slices, same_time)
    actions = actions_of(spark, rows)
    hot = hot_sessions(session_summary(actions), rows_per_split=50)
    assert [r.session_id for r in hot.collect()] == ["hot"]
    steps = funnel.session_steps(actions, hot, slices)
    found = Counter((r.session_id, r.page_id, r.next_page_id) for r in steps.collect())
    assert found == expected_steps(rows)


@pytest.mark.parametrize("rows_per_split", [50, 10**6])
def test_without_adaptive_execution(spark, settings, rows_per_split):
    settings(adaptive__enabled="false")
    rows = random_rows(300, 21)
    actions = actions_of(spark, rows)
    hot = hot_sessions(session_summary(actions), rows_per_split)
    steps = funnel.session_steps(actions, hot)
    found = Counter((r.session_id, r.page_id, r.next_page_id) for r in steps.collect())
    assert found == expected_steps(rows)


def test_rows_without_session_are_split_too(spark):
    rows = random_rows(400, 12, hot=None)
    actions = actions_of(spark, rows)
    hot = hot_sessions(session_summary(actions), rows_per_split=50)
    assert [r.session_id for r in hot.collect()] == [None]
    steps = funnel.session_steps(actions, hot, 6)
    found = Counter((r.session_id, r.page_id, r.next_page_id) for r in steps.collect())
    assert found == expected_steps(rows)


def test_hot_session_of_copies_of_one_row(spark):
    copies = [action("hot", 1, 5, 3)] * 300 + [action("hot", 1, 4, 1), action("hot", 1, 6, 2)]
    actions = actions_of(spark, copies).repartition(6)
    hot = hot_sessions(session_summary(actions), rows_per_split=50)
    steps = funnel.session_steps(actions, hot, 5)
    found = Counter((r.page_id, r.next_page_id) for r in steps.collect())
    assert found == {(1, 3): 1, (3, 3): 299, (3, 2): 1, (2, None): 1}


def test_every_session_hot(spark):
    rows = random_rows(300, 9)
    actions = actions_of(spark, rows)
    hot = hot_sessions(session_summary(actions), rows_per_split=1)
    steps = funnel.session_steps(actions, hot)
    found = Counter((r.session_id, r.page_id, r.next_page_id) for r in steps.collect())
    assert found == expected_steps(rows)


def test_pair_counts_match_brute_force(spark):
    rows = random_rows(500, 2)
    path = (1, 2, 3, 1, 2)
    pairs = funnel.session_page_pairs(funnel.session_steps(actions_of(spark, rows)))
    expected = Counter(f"{a}_{b}" for (_, a, b), n in expected_steps(rows).items() for _ in range(n))
    found = {r.pair: r.pv for r in funnel.page_pair_pv(pairs, path).collect()}
    assert found == {pair: expected[pair] for pair in ("1_2", "2_3", "3_1")}
    assert sum(found.values()) <= len(rows) - len({row[2] for row in rows})


def test_conversion(spark):
    assert conversion_of(spark, EDGE, (1, 2, 3)) == [(1, "1_2", 1, 2, 0.5), (2, "2_3", 1, 1, 1.0)]
    assert funnel.start_page_pv(actions_of(spark, EDGE), (1, 2, 3)).first().pv == 2


def test_conversion_over_a_missing_pair(spark):
    assert conversion_of(spark, EDGE, (1, 2, 8, 3)) == [
        (1, "1_2", 1, 2, 0.5), (2, "2_8", 0, 1, 0.0), (3, "8_3", 0, 0, None),
    ]


def test_a_pair_twice_in_the_path_keeps_both_positions(spark):
    rows = [action("s", 1, i, page) for i, page in enumerate([1, 2, 1, 2, 1])]
    assert [(pos, pair, rate) for pos, pair, _, _, rate in conversion_of(spark, rows, (1, 2, 1, 2))] == [
        (1, "1_2", 0.67), (2, "2_1", 1.0), (3, "1_2", 1.0),
    ]


def test_packed_report_and_back(spark):
    steps = funnel.session_steps(actions_of(spark, EDGE))
    report = funnel.page_split_convert_rate(funnel.page_conversion(steps, (1, 2, 3)), "t")
    assert tuple(report.first()) == ("t", "1_2=0.5|2_3=1.0")
    missing = funnel.page_split_convert_rate(funnel.page_conversion(steps, (1, 2, 8, 3)), "t")
    assert missing.first().convertRate == "1_2=0.5|2_8=0.0|8_3="
    decoded = packed.kv_report_decode(missing, "convertRate").orderBy("pos").collect()
    assert [tuple(r) for r in decoded] == [
        ("t", 1, "1_2", "0.5"), ("t", 2, "2_8", "0.0"), ("t", 3, "8_3", None),
    ]


def test_packed_fields(spark):
    df = spark.createDataFrame([("a=1|b=|c=x=y|a=2",)], "r STRING")
    found = packed.kv_report_decode(df, "r").orderBy("pos").collect()
    assert [tuple(r) for r in found] == [(1, "a", "1"), (2, "b", None), (3, "c", "x=y"), (4, "a", "2")]
    row = df.select(
        packed.kv_value(df.r, "a"), packed.kv_value(df.r, "b"), packed.kv_value(df.r, "z"),
        packed.kv_replaced(df.r, "b", "5"), packed.kv_replaced(df.r, "z", "5"),
    ).first()
    assert tuple(row) == ("1", None, None, "a=1|b=5|c=x=y|a=2", "a=1|b=|c=x=y|a=2")


def test_missing_report_keeps_its_row(spark):
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "1_2=0.5")], "taskid STRING, r STRING")
    found = sorted(map(tuple, packed.kv_report_decode(df, "r").collect()))
    assert found == [("a", None, None, None), ("b", None, None, None), ("c", 1, "1_2", "0.5")]


def test_pages_without_views_keep_their_pair(spark, monkeypatch):
    from clicktrail.plans import queries

    monkeypatch.setattr(queries, "PARAMS", replace(queries.PARAMS, target_page_flow=(1, 2, 12, 3)))
    found = queries.QUERIES["target_page_pairs"](spark, "/root/testdata/sf0.001").collect()
    assert {r.pair: r.page_pv > 0 for r in found} == {"1_2": True, "2_12": True, "12_3": False}
