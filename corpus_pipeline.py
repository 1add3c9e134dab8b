"""Training-data pipeline: documents to packed token sequences in five stages."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.llm import forest, mixing, pii, queries, toxicity
from clicktrail.sources.shared import discard, staged, staged_alone


def _whole(docs: DataFrame, *columns) -> DataFrame:
    """Each row as a struct, next to the columns an operator reads: none of the user's columns can clash with the operator's."""
    return docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("document"), *columns)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifiers do not reject; of repeated rows all or none go.

    Null and empty texts hold nothing toxic and stay, as all documents do where labels have no toxic one.
    Long texts are judged whole, an empty table stays empty, columns of any name stay as they are.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    classifiers = toxicity.trained(docs, labels, toxicity.learned_fold())
    return toxicity.scored(_whole(docs, "text"), classifiers).where(F.col("score") < queries.TOXIC_FROM).select("document.*")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, by shingles of five words: one with the smallest doc_id.

    Rows are compared one by one, so rows that repeat a doc_id with unlike texts
    all stay, and of equal rows one; those without words, null and empty texts among them, are copies of each other. Rows without doc_id
    cannot be told apart by one and all stay. Long texts count whole, an empty table stays empty, columns of any name stay as they are.
    """
    named = _whole(docs.where("doc_id IS NOT NULL"), "doc_id", "text", F.monotonically_increasing_id().alias("row"), F.xxhash64(*docs.columns).alias("hash"))
    rows = staged(named, "rows")
    groups = forest.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("row"), F.col("component_id").alias("component"), (F.col("n_shingles") == 0).alias("empty"))
    group = F.when(F.col("empty"), F.col("doc_id")).otherwise(F.col("component"))
    of_group = rows.select("row", "hash", "doc_id").join(groups, "row").groupBy("empty", group.alias("group"))
    kept = of_group.agg(F.min(F.struct("doc_id", "hash", "row")).alias("first")).select("first.row")
    return rows.join(kept, "row", "left_semi").select("document.*").unionAll(docs.where("doc_id IS NULL"))


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private data in the texts replaced by its kind; n_chars follows.

    Every row stays, repeated ones are changed alike. A null text stays null and has no n_chars; long texts
    are read whole, an empty table stays empty, other columns of any name stay as they are.
    """
    found = pii.redacted(_whole(docs, "text"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return found.select(*(new.get(name, F.col("document")[name]).alias(name) for name in docs.columns))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources have the same expected number of rows.

    A null source is one, a null doc_id draws like any other, rows that share a doc_id share their count. Texts are not
    read, an empty table stays empty, columns of any name stay as they are.
    """
    return mixing.mixed(_whole(docs, "doc_id", "source"), mixing.target_rates(docs)).select("document.*")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens.

    Null and empty texts are one token, the end of the document; longer texts than a sequence are cut, rows
    may repeat, a null doc_id is one, other columns are not read, an empty table gives no pieces.
    """
    return queries.packed_documents(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("private_data", without_private_data),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]

# Learned scores, MinHash and tokens are beyond SQL; tests check each stage without its operator.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again, and what it needed on the way removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        before, docs = docs, staged_alone(partial(stage, spark, docs, sf_dir), name)
        if number:
            discard(before)
    return docs
