"""Folders every executor can reach, and intermediate tables written there."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_open_scratch: ContextVar[list[str] | None] = ContextVar("folders staged within staged_alone", default=None)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A path, not yet existing, below the folder all executors share.

    That is the cluster's ``spark.checkpoint.dir`` or, where the setting is
    absent, the checkpoint folder of the Spark context.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For tables that several reports use: the lineage ends here, a lost executor
    costs no recomputation, and later joins are planned on the real file size.
    """
    path = shared_folder(df.sparkSession, name)
    if _open_scratch.get() is not None:
        _open_scratch.get().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    _remove(df.sparkSession, {name.rsplit("/", 1)[0] for name in df.inputFiles()})


def _remove(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged_alone(made: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``made`` returns, staged; the tables it staged on the way are removed, also when it fails."""
    outer, own = _open_scratch.get(), []
    token = _open_scratch.set(own)
    result = None
    try:
        result = staged(made(), name)
    finally:
        _open_scratch.reset(token)
        kept = own.pop() if result is not None else None  # the result is written last
        _remove(SparkSession.active(), own)
        if outer is not None and kept:
            outer.append(kept)
    return result
