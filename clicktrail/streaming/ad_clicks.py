"""Decoding ad-click lines, in batch or as a stream."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# The milliseconds whose microseconds a timestamp can hold.
LARGEST_MILLIS = (2**63 - 1) // 1000


def ad_click_events(lines: DataFrame, column: str = "value") -> DataFrame:
    """Typed columns of ``millis province city userid adid`` lines.

    A line that does not have exactly these five numbers, or whose time no
    timestamp can hold, keeps its text in ``_corrupt`` and NULL elsewhere. Times
    before 1970 are negative. Works on batch and streaming frames.
    """
    words = F.split(F.col(column), " ")
    numbers = [F.get(words, F.lit(i)).try_cast("bigint") for i in range(5)]
    millis, province, city, user_id, ad_id = numbers

    valid = (F.size(words) == 5) & millis.between(-LARGEST_MILLIS, LARGEST_MILLIS)
    for number in numbers[1:]:
        valid = valid & number.isNotNull()
    valid = F.coalesce(valid, F.lit(False))

    def decoded(value: Column, name: str) -> Column:
        return F.when(valid, value).alias(name)

    return lines.select(
        decoded(F.timestamp_millis(millis), "ts"),
        decoded(province, "province"),
        decoded(city, "city"),
        decoded(user_id, "user_id"),
        decoded(ad_id, "ad_id"),
        F.when(~valid, F.col(column)).alias("_corrupt"),
    )


def ad_click_source(spark: SparkSession, format: str = "kafka", **options) -> DataFrame:
    """Stream of lines in ``value``.

    For ``kafka`` the options name the servers and the topic
    (``**{"kafka.bootstrap.servers": …, "subscribe": …}``); for ``text`` give
    ``path``, a folder that receives files of lines.
    """
    stream = spark.readStream.format(format).options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def ad_click_stream(
    lines: DataFrame, target: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Append decoded lines to a parquet table, each line once across restarts.

    Without a trigger everything available is processed, then the query stops;
    ``processingTime="5 seconds"`` keeps it running.
    """
    return (
        ad_click_events(lines)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(target)
    )


def ad_click_sinks(lines: DataFrame, clicks: str, corrupt: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Valid lines to the table ``clicks``, the text of all others to ``corrupt``; each line once in one of them.

    Both tables are stored by batch. A batch that is run again after a failure, between the two
    writes or before its progress was saved, replaces its own folders, so a
    restart writes no line twice. Its lines are kept until both are written, so that
    the source is read once. Triggers are those of ``ad_click_stream``.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        events = ad_click_events(batch.persist(StorageLevel.MEMORY_AND_DISK))
        valid = F.col("ts").isNotNull()
        events.where(valid).drop("_corrupt").write.mode("overwrite").parquet(f"{clicks}/batch={batch_id}")
        events.where(~valid).select(F.col("_corrupt").alias("value")).write.mode("overwrite").parquet(f"{corrupt}/batch={batch_id}")
        batch.unpersist()

    return (
        lines.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
