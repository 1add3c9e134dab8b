"""One-step conversion along a path of pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clicktrail.functions import values
from clicktrail.operators.sessions import hot_sessions, session_summary
from clicktrail.operators.skew import by_hotness
from clicktrail.sources.shared import staged

ORDER = ["action_ts", "action_seq"]


def _moves(path: Sequence[int]) -> list[tuple[int, int]]:
    if len(path) < 2:
        raise ValueError("a path needs at least two pages")
    return [(int(a), int(b)) for a, b in zip(path, path[1:])]


def _pair(page: Column, next_page: Column) -> Column:
    return F.concat_ws("_", page.cast("string"), next_page.cast("string"))


def target_page_pairs(spark: SparkSession, path: Sequence[int]) -> DataFrame:
    """``pos, page_id, next_page_id, pair`` for each step of the path; positions from 1."""
    steps = ", ".join(f"({i}, {a}L, {b}L, '{a}_{b}')" for i, (a, b) in enumerate(_moves(path), 1))
    return spark.sql(f"SELECT * FROM VALUES {steps} AS path(pos, page_id, next_page_id, pair)")


def _steps_of_hot_sessions(actions: DataFrame, slices: int | None) -> DataFrame:
    """Following pages within sessions too long to sort in one task.

    Range partitioning on session and time cuts a session into slices in time
    order. Within a slice ``lead`` finds the next page, except for its last row.
    The first and last rows of all slices, two per slice, are few; ordered by
    slice, a slice's last row is followed by the first row of the next. Other
    rows keep to their slice in that second window. The number of the
    input partition comes last in the order: it cuts up even a session of many
    copies of one row, whose order among each other makes no difference.
    """
    order = [*ORDER, "source"]
    keys = ["session_id", *order]
    rows = actions.withColumn("source", F.spark_partition_id())
    cut = rows.repartitionByRange(slices, *keys) if slices else rows.repartitionByRange(*keys)
    in_slice = Window.partitionBy("session_id", "slice").orderBy(*order)
    at_edge = Window.partitionBy("session_id", "inner_slice").orderBy("slice", "is_last")
    return (
        cut.withColumn("slice", F.spark_partition_id())
        .withColumns(
            {
                "next_page_id": F.lead("page_id").over(in_slice),
                "is_first": F.lag(F.lit(True)).over(in_slice).isNull(),
                "is_last": F.lead(F.lit(True)).over(in_slice).isNull(),
            }
        )
        .withColumn("inner_slice", F.when(~(F.col("is_first") | F.col("is_last")), F.col("slice")))
        .withColumn("after_slice", F.lead("page_id").over(at_edge))
        .withColumn(
            "next_page_id",
            F.when(F.col("is_last"), F.col("after_slice")).otherwise(F.col("next_page_id")),
        )
        .select("session_id", "page_id", *ORDER, "next_page_id")
    )


def session_steps(
    actions: DataFrame, hot: DataFrame | None = None, slices: int | None = None
) -> DataFrame:
    """Each action with the page of its session's next action, NULL for the last.

    Actions are ordered by time, then ``action_seq``. Sessions in ``hot`` (at
    most a fixed number, see ``skew``) are cut into slices; all others are
    sorted whole. Without hot sessions adaptive execution drops that branch.
    """
    if hot is None:
        hot = staged(hot_sessions(session_summary(actions)), "hot_sessions")
    long, short = by_hotness(actions.select("session_id", "page_id", *ORDER), "session_id", hot)
    in_session = Window.partitionBy("session_id").orderBy(*ORDER)
    whole = short.withColumn("next_page_id", F.lead("page_id").over(in_session))
    return whole.unionByName(_steps_of_hot_sessions(long, slices))


def session_page_pairs(steps: DataFrame) -> DataFrame:
    """Consecutive pages of each session."""
    return steps.where(F.col("page_id").isNotNull() & F.col("next_page_id").isNotNull()).select(
        "session_id",
        "page_id",
        "next_page_id",
        _pair(F.col("page_id"), F.col("next_page_id")).alias("pair"),
    )


def page_pair_pv(pairs: DataFrame, path: Sequence[int]) -> DataFrame:
    """How often each pair of the path occurs; pairs that never do are absent."""
    wanted = sorted({f"{a}_{b}" for a, b in _moves(path)})
    return pairs.where(F.col("pair").isin(*wanted)).groupBy("pair").agg(F.count(F.lit(1)).alias("pv"))


def start_page_pv(actions: DataFrame, path: Sequence[int]) -> DataFrame:
    """One row: views of the path's first page."""
    return actions.where(F.col("page_id") == path[0]).agg(F.count(F.lit(1)).alias("pv"))


def page_conversion(steps: DataFrame, path: Sequence[int]) -> DataFrame:
    """Rate of each step of the path against the step before it.

    The first step is measured against the views of the first page. Start views
    and all steps are counted in one aggregate over the one-row-per-action steps,
    so the log is read once. A step that never happens has rate 0; a step after
    it has no rate.
    """
    moves = _moves(path)
    counted = steps.agg(
        F.expr(f"count_if(page_id = {moves[0][0]}) AS pv_0"),
        *(
            F.expr(f"count_if(page_id = {a} AND next_page_id = {b}) AS pv_{i}")
            for i, (a, b) in enumerate(moves, 1)
        ),
    )
    rows = ", ".join(
        f"{i}, '{a}_{b}', pv_{i}, pv_{i - 1}, {values.ratio(f'pv_{i}', f'pv_{i - 1}')}"
        for i, (a, b) in enumerate(moves, 1)
    )
    return counted.selectExpr(f"stack({len(moves)}, {rows}) AS (pos, pair, pv, previous_pv, rate)")


def page_split_convert_rate(conversion: DataFrame, task_id: str) -> DataFrame:
    """The rates packed into one ``pair=rate|pair=rate`` text, in path order."""
    in_order = F.array_sort(F.collect_list(F.struct("pos", "pair", "rate")))
    packed = F.transform(
        in_order,
        lambda step: F.concat(
            step["pair"], F.lit("="), F.coalesce(step["rate"].cast("string"), F.lit(""))
        ),
    )
    return conversion.agg(
        F.lit(task_id).alias("taskid"), F.array_join(packed, "|").alias("convertRate")
    )
