"""Cells: bounded groups of rows that are compared with each other, out of groups of any size.

A group is cut into blocks by hash and every two blocks meet in one cell, so all
rows of a group meet although no task holds the group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dealt(rows: DataFrame, group: list[str], size: Column, row_id: str, block_rows: int, columns: list[str]) -> DataFrame:
    """Rows (group, low, high, block, ``columns``) sorted by cell; ``size`` is the number of rows of the row's group."""
    blocks = F.ceil(size / F.lit(block_rows)).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64(row_id), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    cell = [*group, "low", "high"]
    return (
        rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .select(*cell, "block", *columns)
        .repartition(*cell)
        .sortWithinPartitions(*cell)
    )


def whole(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Tables of whole cells, with where each cell begins, and the end."""
    cell = [*group, "low", "high"]
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        rest = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
        cuts = _runs(rest, cell)
        if len(cuts) > 2:
            yield rest.slice(0, cuts[-2]).combine_chunks(), cuts[:-1]
        rest = rest.slice(cuts[-2])
    if rest is not None:
        yield rest.combine_chunks(), [0, rest.num_rows]


def _runs(rows: pa.Table, cell: list[str]) -> list[int]:
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for name in cell:
        values = rows.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return [*np.flatnonzero(new).tolist(), rows.num_rows]
