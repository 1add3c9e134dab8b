import random
from collections import Counter
from dataclasses import replace

from clicktrail.operators import categories, sessions
from tests.rows import EDGE, PARAMS, action, actions_of, edge_users


def activity_of(spark, rows, params=PARAMS):
    actions = actions_of(spark, rows)
    kept = sessions.filtered_sessions(actions, edge_users(spark), params)
    return categories.session_category_activity(categories.category_events(actions), kept)


def top_of(spark, rows):
    return categories.top10_category(categories.category_activity(activity_of(spark, rows)), "t")


def top_sessions_of(spark, rows):
    clicks = categories.clicks_in_top_categories(activity_of(spark, rows), top_of(spark, rows))
    return categories.top10_session(clicks, "t")


def mixed_rows(n=900, seed=3):
    """Clicks, orders and payments; one session and one category hold a third each."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        session = "hot" if rng.random() < 1 / 3 else f"s{rng.randint(0, 20)}"
        ids = [7 if rng.random() < 1 / 3 else rng.randint(0, 15) for _ in range(rng.randint(1, 3))]
        text = ",".join(map(str, ids))
        kind = rng.choice(["click", "order", "pay", "none"])
        if kind == "click":
            rows.append(action(session, 1, i, click=ids[0]))
        else:
            rows.append(action(session, 1, i, order=text if kind == "order" else None,
                               pay=text if kind == "pay" else None))
    return rows


def expected_totals(rows):
    totals = {}
    for row in rows:
        for position, ids in ((0, [row[6]] if row[6] != -1 else []), (1, (row[8] or "").split(",")),
                              (2, (row[10] or "").split(","))):
            for item in ids:
                if item != "":
                    totals.setdefault(int(item), [0, 0, 0])[position] += 1
    return {key: tuple(value) for key, value in totals.items()}


def test_activity_of_the_edge_rows(spark):
    found = {tuple(r) for r in categories.category_activity(activity_of(spark, EDGE)).collect()}
    assert found == {(1, 1, 0, 0), (11, 1, 0, 0), (7, 0, 2, 0), (3, 0, 1, 0)}
    assert [r.categoryid for r in top_of(spark, EDGE).collect()] == [1, 11, 7, 3]


def test_counts_match_brute_force(spark):
    rows = mixed_rows()
    expected = expected_totals(rows)
    activity = activity_of(spark, rows).cache()
    assert {r[0]: tuple(r)[1:] for r in categories.category_activity(activity).collect()} == expected
    assert {r[0] for r in categories.category_universe(activity).collect()} == set(expected)
    for i, counts in enumerate(
        (categories.category_click_counts, categories.category_order_counts, categories.category_pay_counts)
    ):
        assert dict(map(tuple, counts(activity).collect())) == {c: t[i] for c, t in expected.items() if t[i]}
    activity.unpersist()


def test_one_aggregate_equals_universe_joined_with_three_counts(spark):
    activity = activity_of(spark, mixed_rows(seed=4))
    joined = categories.category_universe(activity)
    for counts in (categories.category_click_counts, categories.category_order_counts, categories.category_pay_counts):
        joined = joined.join(counts(activity), "category_id", "left")
    expected = {tuple(r) for r in joined.na.fill(0).collect()}
    assert {tuple(r) for r in categories.category_activity(activity).collect()} == expected


def test_without_session_filter(spark):
    events = categories.category_events(actions_of(spark, EDGE))
    found = categories.category_activity(categories.session_category_activity(events))
    assert (3, 0, 1, 1) in {tuple(r) for r in found.collect()}


def test_top_categories_break_ties_in_order(spark):
    rows = [action("s", 1, i, click=c) for i, c in enumerate([5, 5, 6, 6, 8, 9])]
    rows += [action("s", 1, 20, order="6,9"), action("s", 1, 21, pay="9"), action("s", 1, 22, order="8")]
    assert [tuple(r)[1:] for r in top_of(spark, rows).collect()] == [
        (6, 2, 1, 0), (5, 2, 0, 0), (9, 1, 1, 1), (8, 1, 1, 0),
    ]
    twelve = [action("s", 1, i, click=c) for i, c in enumerate(range(12))]
    assert [r.categoryid for r in top_of(spark, twelve).collect()] == list(range(10))


def test_session_counts_rank_as_numbers(spark):
    rows, seq = [], 0
    for clicks in range(1, 12):
        for _ in range(clicks):
            seq += 1
            rows.append(action(f"s{clicks:02d}", 1, seq, click=4))
    found = top_sessions_of(spark, rows).orderBy("clickCount").collect()
    assert [r.clickCount for r in found] == list(range(2, 12))
    assert {r.categoryid for r in found} == {4}


def test_session_leading_two_categories_has_its_detail_once(spark):
    rows = [action("s", 1, 1, click=4), action("s", 1, 2, click=5), action("s", 1, 3)]
    actions = actions_of(spark, rows)
    leaders = top_sessions_of(spark, rows)
    assert leaders.count() == 2
    assert categories.top10_session_detail(leaders, actions, "t").count() == 3


def test_top_sessions_match_brute_force(spark):
    rows = mixed_rows(seed=6)
    top = [r.categoryid for r in top_of(spark, rows).collect()]
    clicks = Counter((row[6], row[2]) for row in rows if row[6] in top)
    expected = set()
    for category in top:
        ranked = sorted((-n, s) for (c, s), n in clicks.items() if c == category)[:10]
        expected |= {("t", category, s, -n) for n, s in ranked}
    assert {tuple(r) for r in top_sessions_of(spark, rows).collect()} == expected


def test_filter_reaches_the_counts(spark):
    none = replace(PARAMS, start_age=51, end_age=59)
    assert activity_of(spark, EDGE, none).count() == 0


def test_category_is_cut_before_the_shuffle(spark):
    plan = top_sessions_of(spark, EDGE)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 10, Partial" in plan
    assert "TakeOrderedAndProject(limit=10" in plan
