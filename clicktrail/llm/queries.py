"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.llm import bpe, filteraudit, forest, licenses, maxscore, mixing, packing, pii, repair, signhash, toxicity, urlrules, warc
from clicktrail.sources.shared import shared_folder, staged, staged_alone

Query = Callable[[SparkSession, str], DataFrame]

TOXIC_FROM = 0.7
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"

SITE_RULES = (
    urlrules.site_rule("block", "net", "/"),
    urlrules.site_rule("allow", "example.net", "/en/"),
    urlrules.site_rule("block", "example.com", "/de/"),
    urlrules.site_rule("allow", "org", "/fr/"),
)
# Words that mark a host or a path, standing by themselves.
HOST_WORDS = ("adult", "betting", "bingo", "casino", "escort", "gambling", "jackpot", "lottery", "poker", "porn", "roulette", "slots", "spam", "torrent", "warez", "xxx")
PATH_WORDS = ("cart", "checkout", "login", "logout", "signin", "signup", "unsubscribe", "wp-login")
PATTERN_RULES = (
    *(urlrules.Rule(f"{word} host", "block", rf"(?a)^[^/]*\b{word}\b", (word,)) for word in HOST_WORDS),
    *(urlrules.Rule(f"{word} page", "block", rf"/{word}(?:\.[a-z]+)?(?:/|\Z)", tuple(word.split("-"))) for word in PATH_WORDS),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), folder)
    records = staged(warc.read_archives(spark, folder).drop("payload"), "records")
    captures = warc.transactions(records).where("main IS NOT NULL AND part = 0")
    of_main = ("record_id", "type", "refers_to", "payload_bytes", "payload_digest")
    page_id = F.array_max(F.transform("metadata", lambda m: m["page_id"])).alias("page_id")
    page = staged(captures.select(page_id, *(f"main.{name}" for name in of_main)), "captures")
    response = page.where("type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("first")).distinct()
    revisits = page.where("type = 'revisit'").join(response, "refers_to", "left")
    columns = ("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"))
    return page.where("type <> 'revisit'").select(*columns, F.lit(None).cast("long").alias("refers_to")).unionAll(
        revisits.select(*columns, "first")
    )


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return staged_alone(lambda: forest.near_duplicates(docs, forest.Forest(shingle=2)), "near_duplicates")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pii.with_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return docs.select(
        "doc_id",
        *map(of_kind, pii.BASE_KINDS),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(_table(spark, sf_dir, "documents"))


def packed_documents(docs: DataFrame) -> DataFrame:
    found = packing.pieces(docs, public_tokenizers.path(TOKENIZER), added=True)
    return packing.packed(found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return mixing.mixed(docs, mixing.target_rates(docs))


def op6_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = maxscore.quantised(_table(spark, sf_dir, "embeddings"))
    return staged_alone(lambda: maxscore.top_scores(vectors, vectors.where("vec_id % 50 = 0")), "top_scores")


def op7_signhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return staged_alone(lambda: signhash.near_duplicate_vectors(vectors), "near_duplicate_vectors")


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    found = urlrules.judged(pages, (*SITE_RULES, *PATTERN_RULES))
    named = F.col("rule").isin(*(rule.name for rule in SITE_RULES))
    return found.withColumn("rule", F.when(named, F.col("rule"))).select("page_id", "host", "path", "rule", "verdict")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    classifiers = toxicity.trained(docs, _table(spark, sf_dir, "labels"), toxicity.learned_fold())
    return toxicity.scored(docs, classifiers).select(
        "doc_id",
        (~F.coalesce(toxicity.learned_fold(), F.lit(True))).alias("held_out"),
        "score",
        F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted"),
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = licenses.scanned(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    place, base = F.transform("places", lambda p: p["word"]), F.transform("places", lambda p: p["label"])
    method = F.transform("decided", lambda b: b["label"])
    found = F.concat("blocks", "notices")
    best = F.coalesce(F.array_max(F.transform(found, lambda b: b["containment"])), F.lit(0.0))
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return docs.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(place).alias("first_word"),
        F.array_max(place).alias("last_word"),
        text(base).alias("base_labels"),
        text(F.concat(base, method)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"),
    )


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations")
    rows = repair.damaged(given)
    found = staged_alone(lambda: repair.repairs(rows), "repairs")
    digests = repair.text_digests(repair.repaired_turns(rows, found)).withColumnRenamed("conv_id", "digest_of")
    every = given.select("conv_id").distinct()
    repaired = every.join(found.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")), "left")
    repaired = repaired.join(digests, F.col("conv_id").eqNullSafe(F.col("digest_of")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return repaired.select(
        "conv_id",
        *(F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = filteraudit.mask_counts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return filteraudit.audited(counts)


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encoded(docs, path, public_tokenizers.PATTERN, round_trip=True).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_warc, op2_minhash, op3_pii, op4_packing, op5_mixing, op6_maxscore, op7_signhash, op8_url_rules, op9_toxicity, op10_licenses,
        op11_repair, op12_filter_audit, op13_bpe,
    )
}

_FINITE = "embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))"

ORACLE: dict[str, str] = {
    "op1_warc": """
WITH page AS (SELECT page_id, sha1(coalesce(html, '')) AS h, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
coded AS (
    SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31))::INT, 1)), '') AS payload_digest,
        max(page_id) OVER (PARTITION BY h) AS best
    FROM page)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
    CASE WHEN page_id = best OR best IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = best OR best IS NULL THEN NULL ELSE best END AS refers_to
FROM coded""",
    "op2_minhash": r"""
WITH RECURSIVE doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 2 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END AS s FROM doc),
shingle AS (SELECT doc_id, unnest(s) AS x FROM sets),
sized AS (SELECT doc_id, len(s) AS n FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
    SELECT a, b FROM common JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b WHERE 100 * common.n >= 80 * (p.n + q.n - common.n)),
both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sized UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)
SELECT doc_id, n::BIGINT AS n_shingles, (min(b))::BIGINT AS component_id, min(b) = doc_id AS kept
FROM sized JOIN reach ON reach.a = doc_id GROUP BY doc_id, n""",
    "op5_mixing": f"""
WITH sources AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, 1.0::DOUBLE / (SELECT count(*) FROM sources) * (SELECT sum(n)::DOUBLE FROM sources) / n AS rate FROM sources),
terms AS (SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p FROM rates, range((ceil(rate + 12 * sqrt(rate)) + 31)::INT) t(k)),
steps AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM terms),
drawn AS (
    SELECT *, ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, 'null')), 1, {mixing.HEX_DIGITS}))::BIGINT::DOUBLE / {16**mixing.HEX_DIGITS}::DOUBLE AS u FROM documents),
counted AS (SELECT d.*, (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM d.source AND s.cdf <= d.u) AS n_replicas FROM drawn d),
copied AS (SELECT * EXCLUDE (u), unnest(range(n_replicas)) AS replica FROM counted)
SELECT * EXCLUDE (replica, n_replicas), replica::INT AS replica, n_replicas::INT AS n_replicas,
    md5('0:' || coalesce(doc_id::VARCHAR, 'null') || ':' || replica::VARCHAR) AS shuffle_key
FROM copied""",
    "op6_maxscore": f"""
WITH coded AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings WHERE vec_id IS NOT NULL AND {_FINITE}),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM coded q JOIN coded c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5""",
    "op7_signhash": f"""
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_FINITE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT vec_id, (SELECT count(*) FROM link WHERE link.a = vec_id)::BIGINT AS n_links,
    (SELECT min(b) FROM reach WHERE reach.a = vec_id)::BIGINT AS component_id,
    (SELECT min(b) FROM reach WHERE reach.a = vec_id) = vec_id AS kept
FROM embeddings""",
    "op8_url_rules": r"""
WITH address AS (
    SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
rules(name, host, path, verdict) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
    ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
best AS (
    SELECT a.page_id, a.host, a.path, max_by(r.name, length(r.name)) AS rule, max_by(r.verdict, length(r.name)) AS verdict
    FROM address a LEFT JOIN rules r ON (a.host = r.host OR ends_with(a.host, '.' || r.host)) AND starts_with(a.path, r.path)
    GROUP BY a.page_id, a.host, a.path)
SELECT page_id, host, path, rule, coalesce(verdict, CASE
    WHEN regexp_matches(host || path, '^[^/]*\b(HOST_WORDS)\b') OR regexp_matches(host || path, '/(PATH_WORDS)(\.[a-z]+)?(/|$)')
    THEN 'block' ELSE 'allow' END) AS verdict
FROM best""".replace("HOST_WORDS", "|".join(HOST_WORDS)).replace("PATH_WORDS", "|".join(PATH_WORDS)),
    "op11_repair": r"""
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce(list_concat([b], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
    FROM range(256) r(b)),
given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations),
hashed AS (
    SELECT given.*, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS kind FROM given, crc_table),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM hashed WHERE kind <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || ':' || text)) AS i,
        role[1:1] AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM damaged),
faulty AS (
    SELECT *, CASE WHEN trimmed = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
        coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS wrong FROM placed),
-- the cheapest edits of the first i rows by the state they end in: nothing, system, user, assistant; an edit is {cost, audit, lines}
best(conv_id, i, e, s, u, a) AS (
    SELECT DISTINCT conv_id, 0::BIGINT, {'c': 0::BIGINT, 'w': '', 'l': ['']}, {'c': 999999999::BIGINT, 'w': '', 'l': ['']},
        {'c': 3::BIGINT, 'w': 'I', 'l': ['user:']}, {'c': 6::BIGINT, 'w': 'II', 'l': ['user:', 'assistant:']}
    FROM placed
    UNION ALL
    SELECT conv_id, i, e, s, least(u, {'c': e.c + 3, 'w': e.w || 'I', 'l': ['user:']}, {'c': s.c + 3, 'w': s.w || 'I', 'l': s.l || ['user:']}, {'c': a.c + 3, 'w': a.w || 'I', 'l': a.l || ['user:']}),
        least(a, {'c': u.c + 3, 'w': u.w || 'I', 'l': u.l || ['assistant:']}, {'c': e.c + 6, 'w': e.w || 'II', 'l': ['user:', 'assistant:']}, {'c': s.c + 6, 'w': s.w || 'II', 'l': s.l || ['user:', 'assistant:']})
    FROM (
        SELECT b.conv_id, f.i, {'c': b.e.c + 4, 'w': b.e.w || 'D', 'l': ['']} AS e,
            least({'c': b.s.c + 4, 'w': b.s.w || 'D', 'l': b.s.l}, {'c': CASE WHEN must OR initial <> 's' THEN 999999999 ELSE b.e.c + extra END, 'w': b.e.w || 'K', 'l': [line]}) AS s,
            least({'c': b.u.c + 4, 'w': b.u.w || 'D', 'l': b.u.l},
                {'c': CASE WHEN must THEN 999999999 ELSE b.e.c + extra + (initial <> 'u')::INT * 3 END, 'w': b.e.w || CASE initial WHEN 'u' THEN 'K' ELSE 'R' END, 'l': [CASE initial WHEN 'u' THEN line ELSE 'user:' || text END]},
                {'c': CASE WHEN must THEN 999999999 ELSE b.s.c + extra + (initial <> 'u')::INT * 3 END, 'w': b.s.w || CASE initial WHEN 'u' THEN 'K' ELSE 'R' END, 'l': b.s.l || [CASE initial WHEN 'u' THEN line ELSE 'user:' || text END]},
                {'c': CASE WHEN must THEN 999999999 ELSE b.a.c + extra + (initial <> 'u')::INT * 3 END, 'w': b.a.w || CASE initial WHEN 'u' THEN 'K' ELSE 'R' END, 'l': b.a.l || [CASE initial WHEN 'u' THEN line ELSE 'user:' || text END]}) AS u,
            least({'c': b.a.c + 4, 'w': b.a.w || 'D', 'l': b.a.l},
                {'c': CASE WHEN must THEN 999999999 ELSE b.u.c + extra + (initial <> 'a')::INT * 3 END, 'w': b.u.w || CASE initial WHEN 'a' THEN 'K' ELSE 'R' END, 'l': b.u.l || [CASE initial WHEN 'a' THEN line ELSE 'assistant:' || text END]}) AS a
        FROM best b JOIN (SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS must, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra, role || ':' || text AS line FROM faulty) f
            ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1)),
done AS (
    SELECT conv_id, least(CASE WHEN e.c < a.c OR e.c = a.c AND e.w < a.w THEN e ELSE a END) AS x
    FROM best QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (wrong) AS illegal
    FROM faulty GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(x.c, 0)::BIGINT AS cost, coalesce(x.w, '') AS audit,
    sha256(coalesce(array_to_string(x.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id""",
    "op12_filter_audit": r"""
WITH labelled AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
doc AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS low FROM documents),
failed AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, list_filter([
        CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
        CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) THEN 'C' END,
        CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END, CASE WHEN low < doc_id THEN 'E' END], lambda x: x IS NOT NULL) AS fails
    FROM doc LEFT JOIN labelled USING (doc_id)),
counted AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, step, filter_order[step] AS f, string_split(filter_order[1:step - 1], '') AS earlier FROM orders, range(1, 6) t(step)),
told AS (
    SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT early AND NOT mine), 0) AS kept, coalesce(sum(n) FILTER (NOT early AND mine), 0) AS removed,
        coalesce(sum(n) FILTER (early AND mine), 0) AS redundant, coalesce(sum(n) FILTER (mine AND len(fails) = 1), 0) AS unique_fails,
        coalesce(sum(good) FILTER (NOT early AND mine), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT early AND mine), 0) AS toxic_lost
    FROM (SELECT *, list_has_any(fails, earlier) AS early, list_contains(fails, f) AS mine FROM counted, steps) GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
    unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM told""",
}
