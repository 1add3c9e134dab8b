"""Registered queries against their SQL, and the pipeline's stages against brute force."""

import math
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clicktrail.llm import mixing, pii, queries, toxicity
from test_text_operators import brute_components, placed_well

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def rows_of(records, columns):
    return sorted(repr([None if r[c] is None else (int(r[c]) if isinstance(r[c], (int, bool)) else r[c]) for c in columns]) for r in records)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, tables, name):
    found = queries.QUERIES[name](spark, SF)
    expected = tables.execute(queries.ORACLE[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(found.columns)
    expected = [dict(zip(names, row)) for row in expected.fetchall()]
    assert rows_of([r.asDict() for r in found.collect()], sorted(names)) == rows_of(expected, sorted(names))


def test_every_operator_has_a_query():
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]


def test_contract_columns_without_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    spans = queries.op3_pii(spark, SF).collect()
    assert len(spans) == docs.count() and spans[0]["base_sha256"] is not None
    licenses = queries.op10_licenses(spark, SF)
    assert dict(licenses.dtypes)["n_base"] == "bigint" and licenses.where("n_base > 0 AND labels = ''").count() == 0
    toxic = queries.op9_toxicity(spark, SF)
    assert toxic.where("score < 0 OR score > 1 OR predicted <> int(score >= 0.7)").count() == 0 and toxic.count() == docs.count()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["toxicity"](spark, docs, SF)
    classifiers = toxicity.trained(docs, spark.read.parquet(f"{SF}/labels.parquet"), toxicity.learned_fold())
    rejected = toxicity.scored(docs, classifiers).where(F.col("score") >= queries.TOXIC_FROM).count()
    assert kept.columns == docs.columns and kept.count() == docs.count() - rejected

    unique = stage["near_duplicates"](spark, docs, SF)
    expected = brute_components([(r["doc_id"], r["text"]) for r in docs.collect()], 5)
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(i for i, found in expected.items() if found[2])
    assert unique.columns == docs.columns

    clean = stage["private_data"](spark, docs, SF)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["text"] == pii.redacted_text(texts[r["doc_id"]]) and r["n_chars"] == len(r["text"]) for r in clean.collect())

    mixed = stage["mixing"](spark, docs, SF)
    counts = mixing.mixed(docs, mixing.target_rates(docs)).groupBy("doc_id").count()
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, mixed.groupBy("doc_id").count().collect())) and mixed.columns == docs.columns

    packed = stage["packing"](spark, docs, SF).collect()
    assert placed_well(packed, 2048) <= 1.01 * -(-sum(r["length"] for r in packed) // 2048) + 1
    assert {r["doc_id"] for r in packed} == set(texts)


def test_only_copies_of_a_repeated_doc_id_are_dropped(spark):
    """Rows of one doc_id are judged by their own texts: 5 repeats with unlike ones, one of them a copy of 3's."""
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(3, a), (5, a + " more"), (5, b), (5, b), (5, c), (5, None), (5, ""), (6, "  "), (7, c + " more"), (2, c + " also"), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], schema)
    found = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF)
    assert found.columns == docs.columns
    kept = sorted((r["doc_id"] or 0, (r["text"] or "").strip()) for r in found.collect())
    assert kept == sorted([(0, a), (2, c + " also"), (3, a), (5, b), (5, ""), (6, "")])


def test_stages_keep_odd_rows_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(5)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, "", None, None, 0), (10**9, None, None, "s", None), (10**9, None, None, "s", None), (10**9 + 1, "a@b.cc", "en", None, 6)],
        docs.schema,
    )
    for table, rows in ((docs.unionAll(odd), 10), (docs.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, table, SF)
            if name != "packing":
                assert found.columns == docs.columns
            n = found.count()
            assert n == rows - (rows > 0) if name == "near_duplicates" else n == rows if name == "private_data" else n >= 0


def test_stages_without_their_operators(spark):
    """Each stage's outcome from patterns, labels and arithmetic, not from the functions it calls."""
    stage = dict(corpus_pipeline.STAGES)
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stage["toxicity"](spark, docs, sf).collect()}
    lost = [toxic[i] for i in toxic if i not in kept]
    assert lost.count(1) >= 0.55 * list(toxic.values()).count(1) and lost.count(0) <= 0.03 * list(toxic.values()).count(0)
    assert len(kept) >= 0.8 * docs.count()

    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    address = re.compile(r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b")
    clean = {r["doc_id"]: r for r in stage["private_data"](spark, docs, sf).collect()}
    assert sum(bool(email.search(t)) for t in texts.values()) > 10
    for i, text in texts.items():
        assert not email.search(clean[i]["text"] or "") and not address.search(clean[i]["text"] or "")
        if not re.search(r"[0-9@:]", text):
            assert (clean[i]["text"] or "") == text
        assert clean[i]["n_chars"] in (None, len(clean[i]["text"] or ""))

    mixed = stage["mixing"](spark, docs, sf)
    sources = {r["source"]: r["count"] for r in docs.groupBy("source").count().collect()}
    even = docs.count() / len(sources)
    for row in mixed.groupBy("source").count().collect():  # a Poisson count per document: variance even * rate
        rate = even / sources[row["source"]]
        assert abs(row["count"] - even) <= 5 * math.sqrt(even * max(rate, 1)) + 1
    copies = mixed.groupBy(*docs.columns).count()
    assert copies.join(docs.distinct(), docs.columns, "left_anti").where("source IS NOT NULL").count() == 0


def test_columns_of_any_name_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    names = ("score", "replica", "n_replicas", "shuffle_key", "row", "hash", "document", "_row", "spans", "component", "classifier", "toxic")
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} of "), "doc_id"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SF)
        assert found.schema == docs.schema or [f.dataType for f in found.schema] == [f.dataType for f in docs.schema]
        assert found.columns == docs.columns
        wrong = " OR ".join(f"`{x}` <> concat('{x} of ', doc_id)" for x in names)
        assert found.count() > 0 and found.where(wrong).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= 60


def test_run_leaves_only_its_result(spark, settings, tmp_path):
    from clicktrail.sources import shared

    made = []
    folder = shared.shared_folder
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(shared, "shared_folder", lambda spark, name: made.append(folder(spark, name)) or made[-1])
        rows = corpus_pipeline.run(spark, SF).count()
    there = [path for path in made if os.path.exists(path.removeprefix("file://"))]
    assert rows and len(made) > 10 and there == made[-1:]


def test_run_applies_all_stages(spark):
    found = corpus_pipeline.run(spark, SF).collect()
    assert found and placed_well(found, 2048)
    assert corpus_pipeline.ORACLE_SQL is None
