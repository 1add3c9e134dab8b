import hashlib
import random
import re
from dataclasses import replace

from clicktrail.operators import sampling, sessions
from clicktrail.sources.shared import staged
from tests.rows import EDGE, PARAMS, action, actions_of, edge_users, run_plan_of


def kept_of(spark, rows, params=PARAMS):
    return sessions.filtered_sessions(actions_of(spark, rows), edge_users(spark), params)


def quota_of(spark, rows, params=PARAMS):
    hourly = sampling.session_hourly_counts(kept_of(spark, rows))
    return {(r.start_date, r.start_hour): r.quota for r in sampling.session_sample_quota(hourly, params).collect()}


def many_sessions(n, seed=1):
    """Sessions over three days, one in three of them in the same hour."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        day, hour = (1, 8) if rng.random() < 1 / 3 else (rng.randint(1, 3), rng.randint(0, 23))
        rows.append(action(f"s{i}", 1, i, time=f"2019-02-0{day} {hour}:{rng.randint(10, 59)}:00", keyword=f"k{i % 3}"))
    return rows


def test_counts_and_quota_of_the_edge_rows(spark):
    hourly = sampling.session_hourly_counts(kept_of(spark, EDGE)).collect()
    assert [tuple(r) for r in hourly] == [("2019-02-01", "09", 2, 2)]
    assert quota_of(spark, EDGE) == {("2019-02-01", "09"): 2}


def test_quota_in_whole_numbers(spark):
    rows = [action(f"a{i}", 1, i, time="2019-02-01 9:00:00") for i in range(7)]
    rows += [action(f"b{i}", 1, i, time="2019-02-01 10:00:00") for i in range(3)]
    rows += [action(f"c{i}", 1, i, time="2019-02-02 10:00:00") for i in range(5)]
    params = replace(PARAMS, sample_size=9)
    assert quota_of(spark, rows, params) == {
        ("2019-02-01", "09"): 7 * 4 // 10, ("2019-02-01", "10"): 3 * 4 // 10, ("2019-02-02", "10"): 4,
    }
    assert quota_of(spark, rows, replace(params, extra_per_hour=2)) == {
        ("2019-02-01", "09"): 4, ("2019-02-01", "10"): 3, ("2019-02-02", "10"): 5,
    }


def test_more_days_than_samples(spark):
    rows = [action(f"s{i}", 1, i, time=f"2019-{1 + i // 28:02d}-{1 + i % 28:02d} 9:00:00") for i in range(101)]
    kept = kept_of(spark, rows)
    assert sampling.session_sample(kept, PARAMS).count() == 0
    assert sampling.session_sample(kept, replace(PARAMS, extra_per_hour=1)).count() == 101


def test_sample_is_exact_repeatable_and_from_the_filtered(spark):
    rows = many_sessions(600)
    params = replace(PARAMS, sample_size=200)
    quota = quota_of(spark, rows, params)
    found = sampling.session_sample(kept_of(spark, rows), params).collect()
    drawn = {}
    for row in found:
        cell = (row.start_time[:10], row.start_time[11:13])
        drawn[cell] = drawn.get(cell, 0) + 1
    assert drawn == {cell: n for cell, n in quota.items() if n}
    assert len(found) <= 200 and len({r.session_id for r in found}) == len(found)

    shuffled = sampling.session_sample(kept_of(spark, random.Random(5).sample(rows, len(rows))).repartition(7), params)
    assert set(shuffled.collect()) == set(found)
    other = sampling.session_sample(kept_of(spark, rows), replace(params, seed="8"))
    assert {r.session_id for r in other.collect()} != {r.session_id for r in found}


def test_extract_and_detail(spark):
    actions = actions_of(spark, EDGE)
    kept = sessions.filtered_sessions(actions, edge_users(spark), PARAMS)
    sample = sampling.session_sample(kept, PARAMS)
    found = {tuple(r) for r in sampling.session_random_extract(sample, actions, PARAMS, "t").collect()}
    assert found == {
        ("t", "A", "2019-02-01 09:59:58", "hotpot,new hotpot", "1,11"),
        ("t", "B", "2019-02-01 09:00:00", None, None),
    }
    detail = sampling.session_random_detail(sample, actions, PARAMS, "t")
    assert sorted(r.sessionid for r in detail.collect()) == ["A"] * 4 + ["B"]


def lowest_keys(kept, quota, seed):
    """The sessions an hour gives, ranked whole."""
    cells = {}
    for r in kept.collect():
        if r.start_time:
            key = hashlib.md5((seed + r.session_id).encode()).hexdigest()
            cells.setdefault((r.start_time[:10], r.start_time[11:13]), []).append((key, r.session_id))
    return sorted(s for cell, found in cells.items() for _, s in sorted(found)[: quota[cell]])


def test_bins_draw_the_lowest_keys(spark, monkeypatch):
    rows = many_sessions(900, seed=2)
    for digits in (1, 2, 5):
        monkeypatch.setattr(sampling, "BIN_DIGITS", digits)
        for params in (replace(PARAMS, sample_size=300), replace(PARAMS, sample_size=60, extra_per_hour=2)):
            kept = kept_of(spark, rows)
            found = sorted(r.session_id for r in sampling.session_sample(kept, params).collect())
            assert found == lowest_keys(kept, quota_of(spark, rows, params), params.seed) and found


def test_sessions_without_readable_time_are_never_drawn(spark):
    rows = [action(f"s{i}", 1, i, time=t) for i, t in enumerate(["10:00:01", "2019", "no time", "2019-02-01 10:00:01+02:00"])]
    params = replace(PARAMS, extra_per_hour=3)
    assert quota_of(spark, rows, params) == {(None, None): 0}
    assert sampling.session_sample(kept_of(spark, rows), params).count() == 0
    mixed = rows + [action("ok", 1, 9, time="2019-02-01 9:05:07")]
    assert [r.session_id for r in sampling.session_sample(kept_of(spark, mixed), params).collect()] == ["ok"]


def test_one_histogram_serves_counts_quotas_and_bins(spark):
    kept = staged(kept_of(spark, many_sessions(300)), "kept")
    plan = run_plan_of(sampling.session_sample(kept, replace(PARAMS, sample_size=50)))
    assert len(re.findall(r"Exchange (?:hash|Single)", plan)) <= 4
    assert len(re.findall(r"- Window ", plan)) == 3


def test_plan_has_no_forced_broadcast(spark):
    sample = sampling.session_sample(kept_of(spark, EDGE), PARAMS)
    detail = sampling.session_random_detail(sample, actions_of(spark, EDGE), PARAMS, "t")
    assert "strategy=broadcast" not in detail._jdf.queryExecution().optimizedPlan().toString()
