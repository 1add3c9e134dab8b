"""Operators on texts against brute force, with nulls, empty and long texts, repeated rows and clashing columns."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings as limits
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clicktrail.llm import components, forest, licenses, mixing, packing, pii, queries, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans string, score string, length string, replica string, n_words string"


def documents(spark, rows):
    """Rows of (doc_id, text, source) with extra columns named like the operators' own."""
    return spark.createDataFrame([(i, t, None, s, None, "x", "x", "x", "x", "x") for i, t, s in rows], DOCS)


EDGES = [
    (1, None, "a"), (2, "", "a"), (None, "one two three", None), (3, "  \n\t", "b"), (4, "word", "a"), (4, "word", "a"),
    (5, "long " * 60_000, "b"), (6, "long " * 60_000, "b"), (7, "é日本 <|endoftext|> 😀", None), (None, None, None),
]


# Near duplicates


def brute_components(rows, size, percent=80):
    sets = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        full = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
        sets[doc_id] = full
    ids = sorted(sets)
    lowest = {i: i for i in ids}
    changed = True
    links = [
        (a, b) for a in ids for b in ids
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(lowest[a], lowest[b])
            changed |= lowest[a] != low or lowest[b] != low
            lowest[a] = lowest[b] = low
    return {i: (len(sets[i]), lowest[i], lowest[i] == i) for i in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_are_those_of_brute_force(spark, size):
    rng = random.Random(size)
    rows, words = [], [f"w{i}" for i in range(400)] + ["The", "of"] * 40
    for group in range(30):
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 12, 60, 150]))]
        for _ in range(rng.choice([1, 1, 2, 6, 25])):
            copy = base[:]
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows) * 3 + 1, rng.choice([" ", "\n", "  "]).join(copy)))
    docs = documents(spark, [(i, t, None) for i, t in rows])
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in forest.near_duplicates(docs, forest.Forest(shingle=size)).collect()}
    assert found == brute_components(rows, size)


@pytest.mark.parametrize("neighbours", [1, 4])
def test_pairs_far_apart_in_dense_regions_are_found(spark, neighbours):
    """Many texts alike, but for a few not enough to link: their partners stand far away in every order."""
    rng = random.Random(neighbours)
    shared = [f"s{i}" for i in range(130)]
    rows = []
    for pair in range(250):
        own = [f"p{pair}w{i}" for i in range(35)]
        for copy in range(2):
            mine = own[:18] + [f"{w}c{copy}" for w in own[18:]]
            rows.append((rng.getrandbits(40), " ".join(shared + mine)))
    docs = documents(spark, [(i, t, None) for i, t in rows])
    dense = forest.Forest(shingle=1, neighbours=neighbours, block=64)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in forest.near_duplicates(docs, dense).collect()}
    expected = brute_components(rows, 1)
    assert sum(kept for _, _, kept in expected.values()) == 250
    assert found == expected


def test_near_duplicate_edges(spark):
    found = forest.near_duplicates(documents(spark, EDGES)).collect()
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert len(found) == len(EDGES)
    assert [by_id[i]["n_shingles"] for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert all(by_id[i]["component_id"] == i and by_id[i]["kept"] for i in (1, 2, 3, 4, 5, 7))
    assert by_id[6]["component_id"] == 5 and not by_id[6]["kept"]
    assert all(r["component_id"] is None and not r["kept"] for r in found if r["doc_id"] is None)
    assert forest.near_duplicates(documents(spark, [])).collect() == []


@pytest.mark.parametrize("links_per_task", [2, 30, 500_000])
def test_components_in_many_tasks_and_in_one(spark, links_per_task):
    rng = random.Random(4)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)]
    links += [(i, i + 1) for i in range(200, 260)] + [(400, i) for i in range(401, 440)] + [(7, 7), (None, 3)]
    lowest = {n: n for link in links for n in link if n is not None and link[0] != link[1] and None not in link}
    for _ in lowest:
        for a, b in links:
            if a in lowest and b in lowest:
                lowest[a] = lowest[b] = min(lowest[a], lowest[b])
    found = components.connected_components(spark.createDataFrame(links, "a long, b long"), links_per_task).collect()
    assert sorted((r["node"], r["component"]) for r in found) == sorted(lowest.items())
    assert components.connected_components(spark.createDataFrame([], "a long, b long"), links_per_task).collect() == []


# Private data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def brute_spans(text):
    found = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            valid = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if valid:
                found.append((m.start(), list(BASE).index(kind), m.end()))
    return [(s, list(BASE)[k], e) for s, k, e in sorted(found)]


PARTS = st.sampled_from(["1", "25", "4", "0", "+", "+1", " ", "-", ".", "@", "a", "b.c", "é", "4111 1111 1111 1111", "300", "192.168.0.1", "x@y.z", "(", ")", "://", "\n", "79927398713"])


@limits(max_examples=600, deadline=None)
@given(st.lists(PARTS, max_size=40).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    assert [x for x in pii.spans(text) if x[1] in pii.BASE_KINDS] == brute_spans(text)


def test_method_adds_spans_and_redaction_hides_all():
    text = 'x http://me:pw1@host.org/ iban DE89 3704 0044 0532 0130 00, token = "0123456789abcdef0123" a@b.cc'
    assert [text[s:e] for s, k, e in pii.spans(text) if k in ("login", "iban", "secret")] == ["me:pw1", "DE89 3704 0044 0532 0130 00", "0123456789abcdef0123"]
    assert pii.redacted_text("call +1 (743) 555-3824 or a@b.cc.") == "call [PHONE] or [EMAIL]."


def test_private_data_edges(spark):
    docs = documents(spark, [*EDGES, (9, "a@b.cc " * 20_000, None)])
    found = pii.with_spans(docs)
    assert found.columns == [*(c for c in docs.columns if c != "spans"), "spans"]
    sizes = {r["doc_id"]: len(r["spans"]) for r in found.collect()}
    assert sizes[1] == sizes[2] == sizes[5] == 0 and sizes[9] == 20_000
    clean = pii.redacted(docs)
    assert clean.columns == docs.columns and clean.where("text LIKE '%@%'").count() == 0
    assert clean.where("text IS NULL").count() == 2
    assert pii.with_spans(documents(spark, [])).collect() == [] == pii.redacted(documents(spark, [])).collect()


# Licenses


def brute_blocks(text, scan):
    tokens = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), x))
    found, start = [], 0
    for line in (text or "").split("\n"):
        words = tokens(line)
        half = scan.window // 2
        cuts = [(0, len(words))] if len(words) <= scan.window else [(i, min(i + scan.window, len(words))) for i in range(0, len(words) - half, half)]
        for low, high in cuts:
            for label, template in scan.templates:
                wanted = set(tokens(template))
                share = len(wanted & set(words[low:high])) / len(wanted)
                if share >= scan.threshold - 1e-12:
                    found.append((label, start + low, start + high, share))
        start += len(words)
    return sorted(found)


def test_license_blocks_are_those_of_brute_force(spark):
    rng = random.Random(3)
    scan = licenses.Scan(window=16)
    vocabulary = sorted({w for _, t in scan.templates for w in t.split()} | {"other", "é", "Words"})
    rows = [(i, "\n".join(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(30))) for _ in range(3)), None) for i in range(60)]
    for _, template in scan.templates:
        words = template.split()
        rows.append((len(rows), "x y\n" + " ".join(w for w in words if rng.random() < 0.9), None))
        rows.append((len(rows), "pad " * 40 + template + " pad" * 40, None))
    found = licenses.scanned(documents(spark, [*rows, *EDGES]), scan).collect()
    for r in found:
        assert [(b["label"], b["first"], b["end"], b["containment"]) for b in r["blocks"]] == brute_blocks(r["text"], scan)
    assert sum(len(r["blocks"]) for r in found) > 20
    assert licenses.scanned(documents(spark, []), scan).collect() == []


def brute_notices(text, scan):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = []
    for label, template in scan.templates:
        wanted = licenses._words(template)
        tokens, runs = {w.decode() for w in wanted}, []
        for first in range(len(words)):
            for end in range(first + 1, min(len(words), first + 2 * len(wanted)) + 1):
                both = len(tokens.intersection(words[first:end]))
                if both / len(tokens) >= scan.threshold - 1e-12:
                    runs.append((-both, end, -first))
        taken = []
        for both, end, first in sorted(runs):
            if all(end <= a or b <= -first for a, b in taken):
                taken.append((-first, end))
                found.append((label, -first, end, -both / len(tokens)))
    return sorted(found)


def test_license_notices_over_line_ends_are_those_of_every_word_window(spark):
    rng = random.Random(8)
    scan = licenses.Scan()
    vocabulary = sorted({w for _, t in scan.templates for w in t.split()} | {"other", "é"})
    rows = [(0, "Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software and associated documentation files", None)]
    rows += [(1, "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met", None)]
    for _, template in scan.templates:
        for _ in range(4):
            words = [w for _ in range(rng.choice([1, 1, 3])) for w in template.split() if rng.random() < rng.choice([0.8, 1])]
            words = [x for w in words for x in ([w, rng.choice(vocabulary)] if rng.random() < 0.1 else [w])]
            rows.append((len(rows), "".join(w + rng.choice(["\n", " ", "\n# "]) for w in ["pad"] * rng.randrange(30) + words), None))
    found = licenses.scanned(documents(spark, [*rows, *[e for e in EDGES if len(e[1] or "") < 1000]]), scan).collect()
    for r in found:
        assert [(b["label"], b["first"], b["end"], b["containment"]) for b in r["notices"]] == brute_notices(r["text"], scan)
    first = {r["doc_id"]: [(b["label"], b["first"], b["end"], b["containment"]) for b in r["notices"]] for r in found[:2]}
    assert first == {0: [("mit", 0, 20, 1.0)], 1: [("bsd", 0, 21, 1.0)]}
    assert sum(len(r["notices"]) for r in found) > 60


def test_license_query_finds_wrapped_notices(spark, tmp_path):
    text = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met"
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    row = queries.op10_licenses(spark, str(tmp_path)).first()
    assert (row["labels"], row["score"], row["base_labels"]) == ("bsd", 1.0, "")


def test_license_query_tells_like_notices_apart(spark, tmp_path):
    texts = {
        "Licensed under CC BY-NC 4.0.": "cc-by-nc", "Licensed under\nCC BY-SA 4.0.": "cc-by-sa", "Released under the Apache License": "apache",
        "Licensed under the MIT License, Version 2.0.": "mit", "Released under\nthe License": "", "Licensed under CC BY 4.0": "cc-by",
        "This work is licensed under a Creative Commons\nAttribution 4.0 International License": "cc-by",
        "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation": "gpl,lgpl",
        "Available under the GNU Affero General Public License.": "agpl,gpl", "Licensed under CC BY-NC-SA 4.0": "cc-by-nc-sa",
        "Licensed under CC BY-ND 4.0. Elsewhere: Licensed under CC BY 4.0.": "cc-by,cc-by-nd",
        "Licensed under CC BY-ND 4.0." + " pad" * 70 + " Licensed under CC BY 4.0.": "cc-by,cc-by-nd",
        "Neither may be used to endorse or promote products derived from this\n# software without specific prior written permission": "bsd-3-clause",
        "of the Eclipse Public License 2.0 these accompanying materials are made available under the terms": "epl",
    }
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r for r in queries.op10_licenses(spark, str(tmp_path)).collect()}
    assert [rows[i]["labels"] for i in range(len(texts))] == list(texts.values())
    assert all(rows[i]["score"] >= 0.8 for i in range(len(texts)))


def test_license_query_shows_every_match(spark, tmp_path):
    """The query's columns from every line and word window compared with every template."""
    rng = random.Random(21)
    scan = licenses.Scan()
    texts = [None, "", "x"]
    for _, template in scan.templates:
        for other, _ in ((0, 0), (1, 0), (2, 0)):
            words = [w for w in template.split() if rng.random() < 0.93] + rng.choice(scan.templates)[1].split()[: 6 * other]
            texts.append(rng.choice([" ", "\n"]).join(words) + " pad" * rng.randrange(4))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    own_words = {}
    for label, _ in scan.templates:
        others = {w for x, t in scan.templates if x != label for w in licenses._words(t)}
        own_words[label] = [set(licenses._words(t)) - others or set(licenses._words(t)) for x, t in scan.templates if x == label]
    told = 0
    for row in queries.op10_licenses(spark, str(tmp_path)).collect():
        text = texts[row["doc_id"]]
        matched = brute_blocks(text, scan) + brute_notices(text, scan)
        best = max((share for *_, share in matched), default=0.0)
        assert row["score"] == (1.0 if row["n_base"] else best)
        method = set(filter(None, row["labels"].split(","))) - set(row["base_labels"].split(","))
        assert method <= {label for label, *_ in matched}
        words = set(licenses._words(text or ""))
        assert all(any(own & words for own in own_words[label]) for label in method)
        sole = {label for label, *_ in matched}
        if len(sole) == 1 and any(own & words for own in own_words[min(sole)]) and best == 1.0:
            assert sole <= set(row["labels"].split(","))
            told += 1
    assert told > 5


def test_license_phrases(spark):
    text = "The MIT\nLicense, mit license; Apache-License mit  general public license mit"
    row = licenses.scanned(documents(spark, [(1, text, None)])).first()
    assert [(p["word"], p["label"]) for p in row["places"]] == [(1, "mit"), (3, "mit"), (5, "apache"), (8, "gpl")]
    assert row["n_words"] == 12


# Toxicity


def test_toxicity_learns_from_positives_and_unlabelled_text(spark):
    rng = random.Random(1)
    clean, toxic = [f"w{i}" for i in range(300)], ["zorg", "blick", "snarf"]
    rows, labels = [], []
    for i in range(1200):
        bad = i % 10 == 0
        words = [rng.choice(clean) for _ in range(rng.choice([5, 40, 400]))]
        if bad:
            words[rng.randrange(len(words))] = rng.choice(toxic)
        rows.append((i, " ".join(words), None))
        if i % 2 == 0:
            labels.append((i, int(bad)))
    labels += [(None, 1), (3, None), (100, 0)]
    docs, known = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    classifiers = toxicity.trained(docs, known, toxicity.learned_fold())
    assert len(classifiers) == 3
    found = {r["doc_id"]: float(r["score"]) for r in toxicity.scored(docs, classifiers).collect()}
    caught = sum(found[i] >= 0.7 for i in range(0, 1200, 10))
    assert caught >= 110 and not any(found[i] >= 0.7 for i in range(1200) if i % 10)
    edge = toxicity.scored(documents(spark, [*EDGES, (8, "w1 " * 50_000 + "zorg", None)]), classifiers)
    scores = {r["doc_id"]: r["score"] for r in edge.collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and scores[8] >= 0.7 > scores[1] == scores[2]
    assert toxicity.trained(docs, known.where("toxic = 0"), toxicity.learned_fold()) == []
    assert toxicity.scored(docs, []).where("score <> 0").count() == 0
    assert toxicity.trained(documents(spark, []), known, toxicity.learned_fold()) == []
    assert toxicity.scored(documents(spark, []), classifiers).collect() == []


# Mixing


def test_mixing_meets_target_rates(spark):
    docs = documents(spark, [(i, str(i), "big" if i % 4 else "small") for i in range(8000)])
    rates = mixing.target_rates(docs, {"big": 1.0, "small": 3.0}, total=8000)
    assert {r["source"]: round(r["rate"], 6) for r in rates.collect()} == {"big": round(2000 / 6000, 6), "small": 3.0}
    found = mixing.mixed(docs, rates, seed=5)
    assert found.columns == [*(c for c in docs.columns if c != "replica"), "replica", "n_replicas", "shuffle_key"]
    sizes = {r["source"]: r["count"] for r in found.groupBy("source").count().collect()}
    assert abs(sizes["big"] - 2000) < 200 and abs(sizes["small"] - 6000) < 350
    again = mixing.mixed(docs.repartition(7), rates, seed=5, shuffled=False)
    key = ("doc_id", "replica", "n_replicas", "shuffle_key")
    assert sorted(map(tuple, found.select(*key).collect())) == sorted(map(tuple, again.select(*key).collect()))
    assert found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("n_replicas").alias("m")).where("n <> m").count() == 0
    keys = [r["shuffle_key"] for r in found.select("shuffle_key").collect()]
    assert keys == sorted(keys)


def test_poisson_counts_are_those_of_the_distribution(spark):
    rates = {"a": 0.3, "b": 7.0, None: 999.0, "c": 1000.5, "d": 40_000.0, "e": 3_000_000.0, "f": 0.0}
    draws = [1e-9, 0.03, 0.25, 0.5, 0.777, 0.99, 1 - 1e-7]
    steps = mixing.poisson_steps(spark.createDataFrame(list(rates.items()), "source string, rate double"))
    drawn = steps.crossJoin(spark.createDataFrame([(u,) for u in draws], "u double"))
    found = {(r["source"], r["u"]): r["n"] for r in drawn.select("source", "u", (F.col("first") + mixing._count_up_to(F.col("cdf"), F.col("u"))).alias("n")).collect()}
    expected = {}
    for source, rate in rates.items():
        if rate:
            k = np.arange(max(0, int(rate - 15 * rate**0.5)), int(rate + 15 * rate**0.5) + 60)
            logs = np.cumsum(np.where(k == k[0], 0.0, np.log(rate) - np.log(np.maximum(k, 1))))
            share = np.exp(logs - logs.max())
            cdf = np.cumsum(share / share.sum())
            expected |= {(source, u): int(k[0] + (cdf <= u).sum()) for u in draws}
    assert found == expected
    sizes = {r["source"]: r["n"] for r in steps.select("source", F.size("cdf").alias("n")).collect()}
    assert sizes["e"] < 50_000 and "f" not in sizes


def test_mixing_edges(spark):
    docs = documents(spark, EDGES)
    found = mixing.mixed(docs, mixing.target_rates(docs))
    assert {r["source"] for r in mixing.target_rates(docs).collect()} == {"a", "b", None}
    assert found.where("n_replicas < 1").count() == 0
    assert mixing.mixed(docs, mixing.target_rates(docs, {})).collect() == []
    assert mixing.mixed(documents(spark, []), mixing.target_rates(documents(spark, []))).collect() == []
    large = documents(spark, [(i, "t", "s") for i in range(20)])  # exp(-rate) alone would be 0
    assert abs(mixing.mixed(large, mixing.target_rates(large, total=40_000)).count() - 40_000) < 1000


# Packing


def test_pieces_are_the_tokenizers_ids(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    rng = random.Random(2)
    letters = ["a", " ", "\n", "é", "'s", "12", "—", "日本", "\t", "X", "😀", "<|endoftext|>", "\u0301", "\x00"]
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(60)))) for i in range(200)] + [(i, t) for i, t, _ in EDGES if i]
    found = packing.pieces(documents(spark, [(i + 1000 * (n >= 200), t, None) for n, (i, t) in enumerate(rows)]).dropDuplicates(["doc_id"]), path, limit=256)
    joined = {}
    for r in sorted(found.collect(), key=lambda r: (r["doc_id"], r["piece"])):
        assert r["start"] * 4 == len(joined.get(r["doc_id"], b"")) and r["length"] * 4 == len(r["ids"])
        assert r["length"] == 256 or r["piece"] == 0 and 0 < r["length"] < 256
        joined[r["doc_id"]] = joined.get(r["doc_id"], b"") + bytes(r["ids"])
    for n, (i, text) in enumerate(rows):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        assert joined[i + 1000 * (n >= 200)] == b"".join(x.to_bytes(4, "little") for x in ids)


def test_added_tokens_in_a_text_are_those_of_the_tokenizers_default(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    assert tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    rng = random.Random(9)
    letters = ["a", " ", "\n", "é", "'s", "12", "日本", "<|endoftext|>", "<|endoftext|>", "<|", "endoftext", "|>", "\u0301"]
    rows = [(0, "a <|endoftext|> b"), (1, "<|endoftext|>"), (2, "")]
    rows += [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(40)))) for i in range(3, 200)]
    found = packing.pieces(documents(spark, [(i, t, None) for i, t in rows]), public_tokenizers.path(queries.TOKENIZER), added=True)
    ids = {r["doc_id"]: bytes(r["ids"]) for r in found.collect()}
    packed = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in queries.packed_documents(documents(spark, [(i, t, None) for i, t in rows])).collect()}
    for i, text in rows:
        wanted = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        assert ids[i] == b"".join(x.to_bytes(4, "little") for x in wanted)
        assert packed[i] == (len(wanted), zlib.crc32(ids[i]))


def placed_well(rows, limit):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= limit
    return len(bins)


def fewest_bins(lengths, limit):
    """Every way to place the items, tried out."""
    best, longest_first = len(lengths), sorted(lengths, reverse=True)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(longest_first):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= longest_first[i]}:
            rest = [*rooms]
            rest.remove(room)
            place(i + 1, [*rest, room - longest_first[i]])
        place(i + 1, [*rooms, limit - longest_first[i]])

    place(0, [])
    return best


def test_few_pieces_are_packed_as_well_as_can_be():
    rng = random.Random(1)
    more = []
    for _ in range(600):
        limit = rng.choice([10, 20, 50])
        lengths = [rng.randint(1, limit) if rng.random() < 0.3 else rng.randint(1, limit // 2) for _ in range(rng.randrange(1, 11))]
        bins = packing.pack_bins(lengths, limit)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths))) and all(sum(lengths[i] for i in b) <= limit for b in bins)
        more.append(len(bins) - fewest_bins(lengths, limit))
    assert max(more) <= 1 and sum(more) <= 6


def test_search_saves_sequences():
    """Lengths that fit badly; the search goes on until no exchange is left."""
    rng = random.Random(0)
    lengths = [rng.randint(300, 720) for _ in range(6000)]
    assert len(packing.pack_bins(lengths, 2048)) <= 1513
    tight = [rng.randint(380, 440) for _ in range(2000)]
    assert len(packing.pack_bins(tight, 2048)) <= 1.006 * -(-sum(tight) // 2048)


def test_groups_share_their_last_sequences(spark):
    """Two pieces fill a sequence badly and one is over in each group; the emptier sequences of all groups meet."""
    rows = spark.createDataFrame([(700, i) for i in range(303)], "length int, doc_id long")
    found = packing.packed(rows.repartition(3), packing.Packing(limit=2048, group=31)).collect()
    assert placed_well([r.asDict() | {"piece": r["doc_id"]} for r in found], 2048) == 152


def test_packing_in_rounds(spark):
    rng = random.Random(6)
    lengths = [min(512, max(1, int(rng.lognormvariate(4.5, 1)))) for _ in range(3000)]
    rows = spark.createDataFrame([(i, n, 0) for i, n in enumerate(lengths)], "name long, length long, offset int")
    found = packing.packed(rows, packing.Packing(limit=512, group=400)).collect()
    assert sorted((r["name"], r["length"]) for r in found) == list(enumerate(lengths))
    assert placed_well(found, 512) <= 1.01 * -(-sum(lengths) // 512) + 1
    assert packing.packed(rows.limit(0)).collect() == []
    with pytest.raises(ValueError):
        packing.pack_bins([3, 0], 8)


def test_local_search_empties_bins():
    lengths = [6, 6, 5, 5, 4, 4, 3, 3, 2, 2]
    bins = [[0, 6], [1, 7], [2, 8], [3, 9], [4], [5]]  # 9 9 7 7 4 4 of 10
    found = packing._local_search(bins, lengths, 10)
    assert sorted(i for b in found for i in b) == list(range(10)) and all(sum(lengths[i] for i in b) <= 10 for b in found)
    assert len(found) < len(bins)


@limits(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_bins_hold_everything(lengths):
    bins = packing.pack_bins(lengths, 40)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(0 < sum(lengths[i] for i in b) <= 40 for b in bins)


def test_toxicity_learns_from_documents_however_often_they_are_repeated(spark):
    """Twenty toxic ids of 6000 rows each: 20 positives, not 120,000, and none of them lost to the draw."""
    words = F.concat_ws(" ", *(F.concat(F.lit("w"), F.pmod(F.xxhash64("doc_id", F.lit(i)), F.lit(300)).cast("string")) for i in range(12)))
    text = F.concat_ws(" ", words, F.when(F.col("toxic") == 1, "vileword"))
    of_ids = lambda ids, toxic: ids.select("doc_id", F.lit(toxic).alias("toxic")).withColumn("text", text)
    labelled = of_ids(spark.range(20).select(F.col("id").alias("doc_id")), 1)
    repeated = labelled.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(6000)))).drop("copy")
    clean = of_ids(spark.range(1000, 9000).select(F.col("id").alias("doc_id")), 0)
    hidden = of_ids(spark.range(10_000, 12_000).select(F.col("id").alias("doc_id")), 1)
    docs = repeated.unionAll(clean).unionAll(hidden).select("doc_id", "text")
    labels = labelled.unionAll(clean.where("doc_id < 1100")).select("doc_id", "toxic")
    classifiers = toxicity.trained(docs, labels, F.lit(True))
    found = toxicity.scored(hidden.unionAll(clean), classifiers).groupBy("toxic").agg(F.avg((F.col("score") >= 0.7).cast("int")).alias("share"))
    assert {r["toxic"]: r["share"] for r in found.collect()} == {1: 1.0, 0: 0.0}


def test_toxicity_on_rows_it_did_not_learn_from(spark):
    """The test table's held-out rows: most toxic ones are found, nearly no clean ones."""
    sf = "/root/testdata/sf0.01"
    docs = queries.op9_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    found = {r["toxic"]: r["share"] for r in docs.groupBy("toxic").agg(F.avg("predicted").alias("share")).collect()}
    assert found[1] >= 0.6 and found[0] <= 0.03


def test_toxicity_sample_is_bounded_in_bytes(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("word "), F.lit(200)), F.when(F.col("id") % 2 == 0, "vileword").otherwise("x")).alias("text"))
    labels = docs.where("doc_id < 300").select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("toxic"))
    small = toxicity.Learning(sample_bytes=30_000, support=1, deviations=0.0)
    assert all(len(c.features) for c in toxicity.trained(docs, labels, F.lit(True), small))
    assert all(not len(c.features) for c in toxicity.trained(docs, labels, F.lit(True), toxicity.Learning(sample_bytes=1)))
