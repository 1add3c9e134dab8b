"""Toxic texts by non-negative positive-unlabelled learning.

Only confirmed toxic examples are taken as labels; all other text is unlabelled.
With p the share of toxic texts, the risk of a classifier is
``p * loss of positives as positive + max(0, loss of unlabelled as negative - p * loss of positives as negative)``.
The second part estimates the loss on clean text without any clean label; it is
kept from going negative, which would be overfitting.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.llm import text as tx
from clicktrail.sources.shared import discard, staged

_BUCKETS = 1 << 20


@dataclass(frozen=True)
class Learning:
    """Parameters. Each classifier is fitted on its own sample of expected size
    ``positives`` and ``unlabelled`` different texts, and of ``sample_bytes`` at most for each of the two, drawn by hash; these bounds are all
    that is ever gathered in one task. A feature needs ``support`` positives in the
    sample and an estimated ``share`` of toxic texts, the positives counted ``deviations`` standard deviation low."""

    classifiers: int = 3
    positives: int = 3000
    unlabelled: int = 12000
    sample_bytes: int = 1 << 28
    support: int = 5
    deviations: float = 1.0
    share: float = 0.5
    prefixes: tuple[int, ...] = (5, 6)
    rounds: int = 300
    rate: float = 0.3
    penalty: float = 1e-5


@dataclass(frozen=True)
class Classifier:
    """Non-negative weights of word features, by ascending feature, and a bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def _features(texts: pa.Array, learning: Learning) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of the words, and of the beginnings of longer words."""
    found = tx.words(texts, tx.ALPHANUMERIC)
    documents, features = [found.document], [found.hashes().view(np.int64)]
    for length in learning.prefixes:
        longer = found.end - found.start > length
        documents.append(found.document[longer])
        features.append((found.hashes(length)[longer] ^ np.uint64(length * 0x9E3779B97F4A7C15 % 2**64)).view(np.int64))
    return np.concatenate(documents), np.concatenate(features)


def _risk_gradient(score: np.ndarray, positive: np.ndarray, prior: float) -> np.ndarray:
    """Gradient of the non-negative risk by score, for logistic loss."""
    toxic = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    n_positive, n_other = max(1, positive.sum()), max(1, (~positive).sum())
    as_positive = np.where(positive, prior * (toxic - 1) / n_positive, 0)
    loss_as_negative = np.logaddexp(0, score)
    clean_risk = loss_as_negative[~positive].sum() / n_other - prior * loss_as_negative[positive].sum() / n_positive
    if clean_risk <= 0:
        return as_positive
    return as_positive + np.where(positive, -prior * toxic / n_positive, toxic / n_other)


def _telling(feature: np.ndarray, of_positive: np.ndarray, positive: np.ndarray, prior: float, learning: Learning) -> np.ndarray:
    """Features whose texts are toxic in at least ``share`` of cases by the class-prior-corrected estimate.

    That is prior times their frequency in positives over that in unlabelled text. The former is taken at its lower
    confidence bound, so a rare feature has to be the clearer, but none is too rare for large samples.
    """
    names, counts = np.unique(feature, return_counts=True)
    hits = np.zeros(len(names))
    found, n = np.unique(feature[of_positive], return_counts=True)
    hits[np.searchsorted(names, found)] = n
    in_positive = (hits - learning.deviations * np.sqrt(hits)) / max(1, positive.sum())
    in_other = (counts - hits) / max(1, (~positive).sum())
    return names[(hits >= learning.support) & (in_positive > 0) & (prior * in_positive >= learning.share * in_other)]


def fitted(row: np.ndarray, feature: np.ndarray, positive: np.ndarray, prior: float, learning: Learning) -> Classifier:
    """Fit one classifier to the distinct (row, feature) pairs of a sample.

    Weights are kept at zero or above, so clean words neither speak for nor
    against: a few toxic words count as much in a long text as in a short one.
    """
    names = _telling(feature, positive[row], positive, prior, learning)
    weights, bias = np.zeros(len(names)), float(np.log(prior / (1 - prior)))
    if len(names):
        place = np.minimum(np.searchsorted(names, feature), len(names) - 1)
        use = names[place] == feature
        row, place = row[use], place[use]
        speed, bias_speed = np.full(len(names), 1e-8), 1e-8
        for _ in range(learning.rounds):
            score = np.bincount(row, weights=weights[place], minlength=len(positive)) + bias
            slope = _risk_gradient(score, positive, prior)
            step = np.bincount(place, weights=slope[row], minlength=len(names)) + learning.penalty
            speed += step**2
            bias_speed += slope.sum() ** 2
            weights = np.maximum(0, weights - learning.rate * step / np.sqrt(speed))
            bias -= learning.rate * slope.sum() / np.sqrt(bias_speed)
    kept = weights > 0
    return Classifier(names[kept], weights[kept], float(bias))


def trained(docs: DataFrame, labels: DataFrame, usable, learning: Learning = Learning()) -> list[Classifier]:
    """Classifiers from ``docs`` (doc_id, text, ...) and ``labels`` (doc_id, toxic, ...).

    ``usable`` is a condition on doc_id: other documents are not learned from.
    Positives are documents labelled toxic = 1 (in any of their label rows); every
    other usable document is unlabelled, also one labelled 0, whose label only
    counts for the share of toxic texts among the labelled. Rows that repeat a doc_id and text are one document, however
    many they are: they are counted and drawn once; a doc_id with several texts is several. Null
    doc_ids and empty texts are left out. Each task fits one
    classifier; only its weights reach the driver. Without positives there are none.
    """
    known = labels.where(usable).where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(usable).where("doc_id IS NOT NULL AND text <> ''")
    rows = rows.withColumn("document", F.xxhash64("doc_id", "text"))
    different = rows.groupBy("doc_id", "document").agg(F.max(F.octet_length("text")).alias("bytes"))
    different = staged(different.join(known, "doc_id", "left").select("document", "bytes", "toxic"), "toxicity_documents")
    toxic = F.coalesce("toxic", F.lit(False))
    total = different.agg(
        F.count(F.lit(1)).alias("all"),
        F.count("toxic").alias("labelled"),
        F.count_if(toxic).alias("toxic"),
        F.sum(F.when(toxic, F.col("bytes"))).alias("toxic_bytes"),
        F.sum(F.when(~toxic, F.col("bytes"))).alias("other_bytes"),
    ).first()
    if not total["toxic"]:
        discard(different)
        return []
    rest = max(1, total["all"] - total["toxic"])
    share = min(max(total["toxic"] / total["labelled"], 1e-4), 0.5)
    prior = max(1e-4, (share * total["all"] - total["toxic"]) / rest)  # toxic texts among the unlabelled

    of_positive = min(learning.positives / total["toxic"], learning.sample_bytes / total["toxic_bytes"])
    of_other = min(learning.unlabelled / rest, learning.sample_bytes / max(1, total["other_bytes"] or 0))
    drawn = F.pmod(F.xxhash64("document", "classifier", F.lit(5)), F.lit(_BUCKETS)) < F.when(toxic, of_positive).otherwise(of_other) * _BUCKETS
    numbers = F.sequence(F.lit(0), F.lit(learning.classifiers - 1))
    sample = different.select("document", "toxic", F.explode(numbers).alias("classifier")).where(drawn)
    sample = staged(sample.groupBy("document", toxic.alias("positive")).agg(F.collect_list("classifier").alias("classifiers")), "toxicity_sample")
    # the sample is bounded by the parameters, whatever the size of the corpus
    texts = rows.select("document", "text").join(F.broadcast(sample), "document").select("document", "text", "positive", "classifiers")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # at most the sample
        for batch in batches:
            new = [i for i, x in enumerate(batch.column(0).to_pylist()) if x not in seen and not seen.add(x)]
            batch = batch.take(pa.array(new, pa.int64()))
            for low, high in tx.chunks(batch.column(1)):
                part = batch.slice(low, high - low)
                document, feature = _features(part.column(1), learning)
                order = np.argsort(document, kind="stable")
                cuts = np.searchsorted(document[order], np.arange(1, part.num_rows))
                lists = [np.unique(x) for x in np.split(feature[order], cuts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(3), pa.array(lists, pa.list_(pa.int64()))],
                    names=["document", "positive", "classifiers", "features"],
                )

    def fit(rows: pa.Table) -> pa.Table:
        lists = rows.column("features").combine_chunks()
        lengths = np.asarray([len(x) for x in lists], dtype=np.int64)
        found = fitted(
            np.repeat(np.arange(len(lists)), lengths), np.asarray(lists.flatten()), rows.column("positive").to_numpy(), prior, learning
        )
        lists = (pa.array([found.features], pa.list_(pa.int64())), pa.array([found.weights], pa.list_(pa.float64())))
        return pa.table({"features": lists[0], "weights": lists[1], "bias": [found.bias]})

    found = texts.mapInArrow(extract, "document long, positive boolean, classifiers array<int>, features array<long>")
    found = found.groupBy("document").agg(*(F.first(name).alias(name) for name in ("positive", "classifiers", "features")))
    models = (
        found.select(F.explode("classifiers").alias("classifier"), "positive", "features")
        .groupBy("classifier")
        .applyInArrow(fit, "features array<long>, weights array<double>, bias double")
        .collect()
    )
    discard(different)
    discard(sample)
    return [Classifier(np.array(m["features"], np.int64), np.array(m["weights"]), m["bias"]) for m in models]


def scored(docs: DataFrame, classifiers: list[Classifier], learning: Learning = Learning()) -> DataFrame:
    """``docs`` (text, ...) with score: the classifiers' mean probability that the whole text is toxic.

    Only the text is read. Null and empty texts score as texts without known
    words; without classifiers every score is 0. A column named score is
    replaced, other columns stay, repeated rows score alike, an empty table stays empty.
    """

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        total = np.zeros(len(texts))
        for low, high in tx.chunks(texts):
            document, feature = _features(texts.slice(low, high - low), learning)
            for model in classifiers:
                logit = np.full(high - low, model.bias)
                if len(model.features):
                    place = np.minimum(np.searchsorted(model.features, feature), len(model.features) - 1)
                    hit = model.features[place] == feature
                    pairs = np.unique(document[hit] * len(model.features) + place[hit])
                    logit += np.bincount(pairs // len(model.features), weights=model.weights[pairs % len(model.features)], minlength=high - low)
                total[low:high] += 1 / (1 + np.exp(-np.clip(logit, -500, 500))) / len(classifiers)
        return pa.array(np.clip(total, 0, 1))

    return docs.drop("score").withColumn("score", score(F.col("text").cast("string")))


def learned_fold(column: str = "doc_id"):
    """Rows labels are learned from: crc32 of the id as text, mod 3, is not 1."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3 != 1
