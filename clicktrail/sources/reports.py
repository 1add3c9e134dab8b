"""Writing reports and input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter


def report_append(report: DataFrame, target: str, format: str = "parquet", once_per: str | None = None, **options) -> None:
    """Append a report to its table.

    ``target`` is a path for file formats and the ``dbtable`` for ``jdbc``, whose
    other settings (``url``, ``user``, ``password``, …) are passed as options;
    ``format="table"`` appends to a catalog table.

    With ``once_per="taskid"`` the table is stored by that column and the report replaces what it holds of the
    same tasks: a task that is run again, because it failed half-way or was started twice, leaves one copy. All rows of a
    task must come in one call; a report without rows replaces nothing. A database has no
    such partitions, so ``jdbc`` takes no ``once_per``.
    """
    if once_per:
        if format == "jdbc":
            raise ValueError("jdbc can only append")
        if format == "table":
            _replace_in_table(report, target, once_per, options)
        else:
            _dynamic(report).partitionBy(once_per).format(format).options(**options).save(target)
    elif format == "table":
        report.write.mode("append").options(**options).saveAsTable(target)
    elif format == "jdbc":
        report.write.mode("append").format("jdbc").options(dbtable=target, **options).save()
    else:
        report.write.mode("append").format(format).options(**options).save(target)


def _dynamic(df: DataFrame) -> DataFrameWriter:
    """Overwrites the partitions that have rows in ``df``, and no others."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")


def _replace_in_table(df: DataFrame, table: str, partition: str, options: dict | None = None) -> None:
    """A catalog table's partitions replaced; the table is made if there is none, and must be stored by the column."""
    catalog = df.sparkSession.catalog
    if not catalog.tableExists(table):
        df.write.partitionBy(partition).options(**(options or {})).saveAsTable(table)
        return
    if partition not in [column.name for column in catalog.listColumns(table) if column.isPartition]:
        raise ValueError(f"{table} is not stored by {partition}")
    conf, setting = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(setting)
    conf.set(setting, "dynamic")  # the writer's option does not reach insertInto
    try:
        df.select(*df.sparkSession.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        conf.set(setting, before)


def table_overwrite(
    df: DataFrame,
    target: str,
    partition_by: str | None = None,
    catalog: bool = False,
    keep_others: bool = False,
) -> None:
    """Replace a table: a parquet path, or a catalog table with ``catalog=True``.

    ``partition_by`` stores the log by date, so a date range reads only its
    folders. With ``keep_others`` only the dates that ``df`` has rows of are replaced, each at once when the
    write commits; all other dates stay untouched. Rows are rebalanced first: one date's rows come together in files of
    advised size, and a date with very many rows is split over tasks.
    There is no layout by session: a reader takes such a bucket whole, so one
    session with very many rows would always land in one task.
    """
    if keep_others and not partition_by:
        raise ValueError("keep_others needs partition_by")
    if partition_by:
        df = df.hint("rebalance", partition_by)
    if keep_others and catalog:
        _replace_in_table(df, target, partition_by)
        return
    writer = _dynamic(df) if keep_others else df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if catalog:
        writer.saveAsTable(target)
    else:
        writer.parquet(target)
