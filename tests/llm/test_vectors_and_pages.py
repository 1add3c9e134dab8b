"""Operators on vectors and pages against brute force, with nulls, ties, repeated rows and clashing columns."""

import base64
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clicktrail.llm import maxscore, queries, signhash, urlrules, warc
from clicktrail.sources.shared import shared_folder

VECTORS = "vec_id long, embedding array<float>, label int, score string, node long, copies long, block long, code long"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, x, "x", 1, 1, 1, 1) for i, v, x in rows], VECTORS)


ODD = [
    (None, [1.0, 0.0], 1), (9001, None, 1), (9002, [], 1), (9003, [0.0, 0.0], 1), (9004, [float("nan"), 1.0], 1),
    (9005, [float("inf"), 1.0], 1), (9006, [None, 1.0], 1), (9007, [1.0, 0.0], None),
]


def sample(seed, n=300, spread=0.03, dimension=8):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dimension))
    found = []
    for i in range(n):
        v = centres[rng.integers(12)] + spread * rng.standard_normal(dimension)
        found.append((i, [float(np.float32(x)) for x in v], int(rng.integers(2))))
    return found + [(n + j, found[j % 3][1], found[j % 3][2]) for j in range(40)]


def brute_links(rows):
    links = {i: set() for i, _, _ in rows}
    for i, v, x in rows:
        for j, w, y in rows:
            if i < j and x == y and np.dot(v, w) / math.sqrt(np.dot(v, v) * np.dot(w, w)) >= 0.98:
                links[i].add(j)
                links[j].add(i)
    lowest = {i: i for i in links}
    for _ in links:
        for i in links:
            lowest[i] = min([lowest[i], *(lowest[j] for j in links[i])])
    return {i: (len(links[i]), lowest[i], lowest[i] == i) for i in links}


def linked(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def test_vector_links_are_those_of_brute_force(spark):
    rows = sample(1)
    expected = brute_links(rows)
    for block in (1024, 16):  # one block, and dense buckets cut into many
        found = linked(signhash.near_duplicate_vectors(vectors(spark, rows), signhash.SignHashing(block=block)))
        assert found == expected


def test_vector_edges(spark):
    rows = [*ODD, (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0, 0.0], 1)]
    found = signhash.near_duplicate_vectors(vectors(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found}
    assert by_id[1] == (2, 1, True) and by_id[2] == (2, 1, False)
    assert by_id[3] == (0, 3, True) and by_id[4] == (0, 4, True)
    assert by_id[None] == (0, None, False)
    assert all(by_id[i] == (0, i, True) for i in range(9001, 9008))
    assert signhash.near_duplicate_vectors(vectors(spark, [])).collect() == []


def test_rows_of_one_vec_id_share_their_links(spark):
    """One vec_id with several vectors joins all it links with, whatever row the link comes from."""
    a, b = [1.0, 0.0], [0.0, 1.0]
    found = linked(signhash.near_duplicate_vectors(vectors(spark, [(3, a, 1), (5, a, 1), (5, b, 1), (7, b, 1), (7, None, 1)])))
    assert found == {3: (1, 3, True), 5: (2, 3, False), 7: (1, 3, False)}


@pytest.mark.parametrize("block", [1024, 4])
def test_repeated_vec_ids_link_as_in_sql(spark, tmp_path, block):
    rng = np.random.default_rng(block)
    rows = [(int(rng.integers(300)), v, x) for _, v, x in sample(7, 100, 0.06)]
    rows += [rows[i] for i in rng.integers(140, size=40)]
    rows += [(rows[i][0], sample(8, 3, 0.06)[j][1], 0) for i in range(8) for j in range(3)] + [(int(i), None, 1) for i in rng.integers(300, size=20)]
    table = vectors(spark, rows)
    table.write.parquet(str(tmp_path / "embeddings"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT vec_id, embedding, label FROM '{tmp_path}/embeddings/*.parquet'")
    expected = sorted(connection.execute(f"SELECT vec_id, n_links, component_id, kept FROM ({queries.ORACLE['op7_signhash']})").fetchall())
    found = signhash.near_duplicate_vectors(table, signhash.SignHashing(block=block))
    assert sorted(map(tuple, found.select("vec_id", "n_links", "component_id", "kept").collect())) == expected
    assert len({i for i, _, _ in rows}) < len(rows)


def test_shape_follows_the_input():
    hashing = signhash.SignHashing()
    alike = 1 - math.acos(0.98) / math.pi
    for n in (1, 1000, 10**6, 10**9):
        bits, tables = hashing.shape(n)
        assert 1 - (1 - alike**bits) ** tables >= 0.9999 and bits <= 48


@pytest.mark.parametrize("at_once", [1, 7, 1 << 15])
def test_rows_with_partners_are_those_of_all_pairs(monkeypatch, at_once):
    monkeypatch.setattr(signhash, "PAIRS_AT_ONCE", at_once)
    rng = np.random.default_rng(at_once)
    rows, cuts, expected = [], [0], []
    for _ in range(40):
        n, (low, high), table = int(rng.integers(1, 12)), sorted(rng.integers(2, size=2).tolist()), int(rng.integers(4))
        codes = rng.integers(4, size=(n, 5)).astype(np.int32)
        block = rng.choice([low, high], n)
        meets = lambda i, j: low == high or block[i] != block[j]  # noqa: B023, E731
        alike = lambda i, j: sum(bin(x ^ y).count("1") for x, y in zip(codes[i].tolist(), codes[j].tolist())) <= 4  # noqa: B023, E731
        fresh = lambda i, j: not (codes[i] == codes[j])[:table].any()  # noqa: B023, E731
        expected += [any(i != j and meets(i, j) and alike(i, j) and fresh(i, j) for j in range(n)) for i in range(n)]
        rows += [{"low": low, "high": high, "block": int(b), "table": table, "codes": c.tolist()} for b, c in zip(block, codes)]
        cuts.append(len(rows))
    kinds = pa.schema({**dict.fromkeys(("low", "high", "block", "table"), pa.int32()), "codes": pa.list_(pa.int32())})
    found = signhash._partnered(pa.Table.from_pylist(rows, kinds), cuts, 4)
    assert found.tolist() == expected and 0 < sum(expected) < len(expected)


def test_bits_of_pairs_at_the_threshold_stay_within_the_limit():
    hashing = signhash.SignHashing()
    bits, tables = hashing.shape(50_000)
    rng = np.random.default_rng(5)
    a, b = rng.standard_normal((2, 4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    planes = signhash._planes(64, bits, tables, hashing.seed)
    differing = ((a @ planes > 0) != (b @ planes > 0)).sum(axis=1)
    assert differing.max() <= hashing.most_differing(bits * tables) < bits * tables / 4


def brute_top(rows, queries, k=5):
    found = []
    for q, v in queries:
        scores = sorted((-int(np.dot(np.array(v, object), np.array(w, object))), c) for c, w in rows if c != q)
        found += [(q, rank + 1, c, -s) for rank, (s, c) in enumerate(scores[:k])]
    return sorted(found)


def test_top_scores_are_exact(spark):
    for seed, spread, dimension in ((1, 0.5, 16), (2, 0.01, 8), (3, 2.0, 40)):
        table = vectors(spark, [(i, v, 1) for i, v, _ in sample(seed, 400, spread, dimension)] + ODD)
        coded = maxscore.quantised(table)
        rows = [(r["vec_id"], [int(x) for x in r["vector"]]) for r in coded.collect()]
        assert {9003, 9007} <= {i for i, _ in rows} and not {9001, 9004, 9005, 9006, None} & {i for i, _ in rows}
        rows = [(i, v) for i, v in rows if len(v) == dimension]
        coded = coded.where(F.size("vector") == dimension)
        queries = [(i, v) for i, v in rows if i % 10 == 0]
        found = maxscore.top_scores(coded, coded.where("vec_id % 10 = 0"), shard_rows=90, query_rows=15)
        assert sorted(map(tuple, found.collect())) == brute_top(rows, queries)


def test_top_scores_edges(spark):
    few = maxscore.quantised(vectors(spark, [(0, [1.0, -0.5], 1), (0, [1.0, -0.5], 1), (3, [1.0], 1), (2, [1.0], 1), (5, [], 1)]))
    found = sorted(map(tuple, maxscore.top_scores(few, few.where("vec_id = 0")).collect()))
    assert found == [(0, 1, 2, 65536), (0, 2, 3, 65536), (0, 3, 5, 0)]
    empty = maxscore.quantised(vectors(spark, []))
    assert maxscore.top_scores(empty, empty).collect() == [] == maxscore.top_scores(few, empty).collect()


def test_maxscore_skips_vectors_below_the_threshold():
    rng = np.random.default_rng(5)
    sparse = rng.integers(-4, 5, (500, 30)) * (rng.random((500, 30)) < 0.2)
    shard = maxscore.Shard(np.arange(500), sparse.astype(float))
    everything = [sorted((-int(sparse[q] @ sparse[c]), c) for c in range(500) if c != q)[:5] for q in range(100)]
    floors = np.array([-everything[q][4][0] if q % 2 else -np.inf for q in range(100)])  # scores at the floor count
    found = list(shard.best(np.arange(100), sparse[:100].astype(float), floors, 5))
    assert [[(-int(s), int(i)) for i, s in zip(*f)] for f in found] == everything
    above = list(shard.best(np.arange(100), sparse[:100].astype(float), np.array([-f[0][0] + 1.0 for f in everything]), 5))
    assert all(len(ids) == 0 for ids, _ in above)


# URL rules

RULES = (
    urlrules.site_rule("block", "net", "/"),
    urlrules.site_rule("allow", "example.net", "/en/"),
    urlrules.site_rule("block", "com", "/en"),
    urlrules.Rule("spam", "block", r"^[^/]*\bspam-", ("spam",)),
    urlrules.Rule("numbers", "block", r"/[0-9]{6}$"),
)
URLS = [
    "http://a.example.net/en/1", "https://EXAMPLE.net/fr/1", "http://xnet/en/", "http://net", "http://net?x=/", "http://net/", "http://www.com/english",
    "http://a.com/fr/en/", "http://spam-x.org/", "http://a.org/123456", "http://a.org/123456/", None, "", "no scheme", "x://y://z.net/", "HTTP://É.NET/x",
    "http://a.b.example.net/en/" + "x" * 100_000,
]


def brute_verdict(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [r for r in RULES[:3] if (host == (h := r.name.split("/")[0]) or host.endswith("." + h)) and path.startswith(r.name[len(h) :])]
    if fits:
        best = max(fits, key=lambda r: len(r.name))
        return host, path, best.name, best.verdict
    tail = path.rsplit("/", 1)[-1]
    if len(tail) == 6 and tail.isdigit():
        return host, path, "numbers", "block"
    return (host, path, "spam", "block") if "spam-" in host else (host, path, None, "allow")


def test_url_verdicts(spark):
    pages = spark.createDataFrame([(i, u, "x", "x") for i, u in enumerate([*URLS, URLS[0]])], "page_id long, url string, host string, rule string")
    found = urlrules.judged(pages, RULES)
    for r in found.collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute_verdict(r["url"])
    assert urlrules.judged(pages.limit(0), RULES).collect() == []


def test_rules_are_indexed_by_their_rarest_token(spark):
    pages = spark.createDataFrame([(u,) for u in ["http://a.net/en/"] * 3 + ["http://b.example.net/"] * 2], "url string")
    index = urlrules.rule_index(urlrules.with_address(pages), RULES)
    assert {k: [r.name for r in v] for k, v in index.items()} == {
        "net": ["net/"], "example": ["example.net/en/"], "com": ["com/en"], "spam": ["spam"], urlrules.ALWAYS: ["numbers"],
    }


def test_many_rules_give_what_all_of_them_would(spark):
    """20,000 rules; the tasks compile those that URLs fetch."""
    rng = random.Random(13)
    words = [f"t{i}" for i in range(3000)]
    rules = [urlrules.site_rule(rng.choice(["block", "allow"]), f"{rng.choice(words)}.example", f"/{rng.choice(words)}/") for _ in range(12_000)]
    rules += [urlrules.Rule(f"r{i}", "block", rf"/{(w := rng.choice(words))}-[0-9]+", (w,)) for i in range(8000)]
    urls = [f"http://{rng.choice(words)}.example/{rng.choice(words)}/{rng.choice(words)}-{i}" for i in range(150)]
    urls += [f"http://{r.name}{i}" for i, r in enumerate(rng.sample(rules[:12_000], 50))]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    compiled = [(r, re.compile(r.pattern)) for r in rules]
    for row in urlrules.judged(pages, rules).collect():
        fits = [r for r, pattern in compiled if pattern.search(row["host"] + row["path"])]
        best = max(fits, key=lambda r: (r.rank, len(r.name), r.verdict == "block", r.name), default=None)
        assert (row["rule"], row["verdict"]) == ((best.name, best.verdict) if best else (None, "allow"))


def test_only_fetched_rules_are_compiled(spark):
    pages = spark.createDataFrame([("http://a.example/x",), ("http://b.example/y",)], "url string")
    broken = urlrules.Rule("never fetched", "block", "(", ("unseen",))
    assert urlrules.judged(pages, [broken, urlrules.site_rule("block", "a.example", "/")]).where("verdict = 'block'").count() == 1


def test_pattern_rules_fire_on_the_test_pages(spark):
    found = queries.op8_url_rules(spark, "/root/testdata/sf0.1").where("rule IS NULL AND verdict = 'block'")
    hosts = {r["host"] for r in found.select("host").distinct().collect()}
    assert hosts == {"m.casino-win.example.com", "www.spam-farm.example.com"}


# Archives


def captures(spark, rows, **options):
    pages = spark.createDataFrame([(*row, "x", "x") for row in rows], "page_id long, url string, html string, digest string, revisit string")
    folder = shared_folder(spark, "archives")
    warc.write_archives(pages, folder, **options)
    records = warc.read_archives(spark, folder)
    return records, warc.transactions(records)


def test_archive_round_trip(spark):
    long = "<p>\r\n\r\né\r\n" * 30_000
    rows = [
        (1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, "same"), (4, "http://c/\r\nX: y", "ends with\r\n\r\n"), (5, "d", "\r\n"),
        (6, "e", None), (7, "f", ""), (8, "g", long), (None, "h", "same"), (None, "i", "alone"), (9, "j", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc"),
    ]
    records, found = captures(spark, rows)
    found = found.collect()
    assert len(found) == len(rows) and records.count() == 3 * len(rows)
    assert records.where("digest_matches = false").count() == 0
    by_id = {r["metadata"][0]["page_id"]: r for r in found if r["metadata"][0]["page_id"] is not None}
    for page_id, _, html in rows:
        if page_id is None:
            continue
        main, payload = by_id[page_id]["main"], (html or "").encode()
        assert len(by_id[page_id]["requests"]) == len(by_id[page_id]["metadata"]) == 1
        assert main["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode() and main["payload_bytes"] == len(payload)
        revisit = page_id in (1, 2, 6)
        assert main["type"] == ("revisit" if revisit else "response") and bytes(main["payload"]) == (b"" if revisit else payload)
    assert by_id[1]["main"]["refers_to"] == by_id[3]["main"]["record_id"]
    nameless = sorted(r["main"]["type"] for r in found if r["metadata"][0]["page_id"] is None)
    assert nameless == ["response", "revisit"]


def test_archive_limits_and_empty_table(spark):
    _, found = captures(spark, [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "longer"), (4, "d", "longer")], min_bytes=3)
    assert sorted(r["main"]["type"] for r in found.collect()) == ["response"] * 3 + ["revisit"]
    records, found = captures(spark, [])
    assert records.collect() == [] == found.collect()
    _, twice = captures(spark, [(1, "a", "x"), (1, "a", "x")])
    assert [(r["main"]["type"], len(r["metadata"])) for r in twice.collect()] == [("response", 2)] * 2


def test_transactions_follow_links_in_any_direction(spark):
    rows = [
        ("r1", "response", ["q1"]), ("q1", "request", []), ("m1", "metadata", ["q1"]), ("m2", "metadata", ["r1"]),
        ("r2", "resource", []), ("q9", "request", ["gone"]), ("m9", "metadata", ["gone"]), (None, "metadata", []), ("r3", None, None),
    ] + [(f"x{i}", "metadata", ["r2"]) for i in range(50)]
    records = spark.createDataFrame(rows, "record_id string, type string, concurrent_to array<string>")
    found = warc.transactions(records, max_nested=20).collect()
    first = next(r for r in found if r["capture_id"] == "r1")
    assert [x["record_id"] for x in first["requests"]] == ["q1"] and sorted(x["record_id"] for x in first["metadata"]) == ["m1", "m2"]
    parts = [r for r in found if r["capture_id"] == "r2"]
    assert len(parts) == 3 and sum(len(r["metadata"]) for r in parts) == 50
    orphans = {r["capture_id"]: len(r["requests"]) + len(r["metadata"]) for r in found if r["main"] is None}
    assert orphans["gone"] == 2 and len(orphans) == 3
    held = sum(len(r["requests"]) + len(r["metadata"]) for r in found) + len({r["capture_id"] for r in found if r["main"]})
    assert held == len(rows)
