import os

import pytest
from pyspark.sql import functions as F

from clicktrail.operators import actions as log
from clicktrail.operators import sessions
from clicktrail.plans import jobs
from clicktrail.schemas import AREA_LEVELS, PRODUCT_INFO
from clicktrail.sources import shared
from clicktrail.sources.dimensions import city_dimension
from clicktrail.sources.reports import report_append, table_overwrite
from tests.rows import EDGE, PARAMS, action, edge_users, log_of, plan_of


def days_log(spark):
    """30 days; one day holds a third of the rows."""
    rows = [action(f"s{i % 50}", 1, i, date=f"2019-02-{1 if i % 3 == 0 else 1 + i % 28:02d}", click=i % 9)
            for i in range(900)]
    return log_of(spark, rows)


def test_reports_append(spark, tmp_path):
    target = str(tmp_path / "reports")
    one = spark.createDataFrame([("t1", 1)], "taskid STRING, n INT")
    two = spark.createDataFrame([("t2", 2)], "taskid STRING, n INT")
    report_append(one, target)
    report_append(two, target)
    assert {tuple(r) for r in spark.read.parquet(target).collect()} == {("t1", 1), ("t2", 2)}
    report_append(one, target + "_csv", format="csv", header=True)
    assert spark.read.csv(target + "_csv", header=True).count() == 1


def test_reports_append_to_a_catalog_table(spark):
    one = spark.createDataFrame([("t1", 1)], "taskid STRING, n INT")
    report_append(one, "appended", format="table")
    report_append(one, "appended", format="table")
    assert spark.table("appended").count() == 2
    spark.sql("DROP TABLE appended")


@pytest.mark.parametrize("format", ["parquet", "json", "table"])
def test_a_task_saved_again_leaves_one_copy(spark, tmp_path, format):
    target = "saved_once" if format == "table" else str(tmp_path / "reports")
    schema = "taskid STRING, n INT"
    save = lambda rows: report_append(spark.createDataFrame(rows, schema), target, format, once_per="taskid")
    for rows in ([("007", 1), ("007", 2)], [("t2", 3)], [("007", 4)], [("007", 4)], []):
        save(rows)
    stored = spark.table(target) if format == "table" else spark.read.schema(schema).format(format).load(target)
    assert sorted((r.taskid, r.n) for r in stored.collect()) == [("007", 4), ("t2", 3)]
    if format == "table":
        spark.sql("DROP TABLE saved_once")


def test_once_per_task_needs_partitions(spark):
    one = spark.createDataFrame([("t1", 1)], "taskid STRING, n INT")
    with pytest.raises(ValueError, match="append"):
        report_append(one, "t", "jdbc", once_per="taskid")
    report_append(one, "appended_flat", format="table")
    with pytest.raises(ValueError, match="not stored by"):
        report_append(one, "appended_flat", format="table", once_per="taskid")
    spark.sql("DROP TABLE appended_flat")


@pytest.mark.parametrize("catalog", [False, True])
def test_replacing_dates_keeps_the_others(spark, tmp_path, catalog):
    target = "dated_log" if catalog else str(tmp_path / "log")
    source = days_log(spark)
    read = lambda: spark.table(target) if catalog else spark.read.schema(source.schema).parquet(target)
    table_overwrite(source, target, "date", catalog=catalog, keep_others=True)
    others = lambda: {name for name in read().inputFiles() if "date=2019-02-03" not in name}
    files = others()
    third = source.where("date = '2019-02-03'").limit(2).withColumn("page_id", F.lit(77).cast("long"))
    for _ in range(2):
        table_overwrite(third, target, "date", catalog=catalog, keep_others=True)
    stored = read()
    assert stored.where("date = '2019-02-03'").select("page_id").collect() == [(77,), (77,)]
    assert others() == files and len(files) > 20
    assert stored.count() == source.where("date <> '2019-02-03'").count() + 2
    with pytest.raises(ValueError, match="partition_by"):
        table_overwrite(source, target, keep_others=True)
    if catalog:
        spark.sql("DROP TABLE dated_log")


def test_overwrite_replaces_and_prunes_by_date(spark, tmp_path):
    target = str(tmp_path / "log")
    source = days_log(spark)
    table_overwrite(source, target, "date")
    table_overwrite(source.where("date >= '2019-02-10'"), target, "date")
    stored = spark.read.schema(source.schema).parquet(target)
    assert stored.agg(F.min("date")).first()[0] == "2019-02-10"
    assert stored.count() == source.where("date >= '2019-02-10'").count()
    plan = plan_of(log.clicked_products(stored, PARAMS))
    partition_filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "2019-02-01" in partition_filters and "2019-02-28" in partition_filters
    assert "ReadSchema: struct<click_product_id:bigint,city_id:bigint>" in plan


def test_date_filter_is_pushed_into_an_unpartitioned_log(spark, tmp_path):
    target = str(tmp_path / "flat")
    source = days_log(spark)
    table_overwrite(source, target)
    stored = spark.read.schema(source.schema).parquet(target)
    summary = sessions.session_summary(log.normalised_actions(log.actions_in_range(stored, PARAMS)))
    plan = plan_of(summary.select("session_id", "step_length"))
    assert "GreaterThanOrEqual(date,2019-02-01)" in plan and "LessThanOrEqual(date,2019-02-28)" in plan
    assert "ReadSchema: struct<date:string,session_id:string>" in plan


def test_hot_session_in_the_stored_log_is_read_by_many_tasks(spark, settings):
    settings(adaptive__advisoryPartitionSizeInBytes="20KB", adaptive__coalescePartitions__enabled="false",
             files__maxPartitionBytes="20KB", files__openCostInBytes="1KB")
    rows = [action("hot" if i % 3 == 0 else f"s{i % 50}", 1, i, keyword=f"k{i}") for i in range(6000)]
    target = shared.shared_folder(spark, "stored_hot")
    table_overwrite(log_of(spark, rows).repartition(8), target, "date")
    stored = spark.read.parquet(target).where("session_id = 'hot'")
    sizes = [n for n in stored.rdd.glom().map(len).collect() if n]
    assert sum(sizes) == 2000 and max(sizes) <= 1000


def test_staged_table_can_be_discarded(spark):
    made = shared.staged(spark.range(5), "five")
    files = [name.removeprefix("file://") for name in made.inputFiles()]
    shared.discard(made)
    assert files and not any(os.path.exists(name) for name in files)


def test_only_the_result_of_a_step_stays(spark):
    names = []

    def inner():
        table = shared.staged(spark.range(3), "inner")
        names.extend(table.inputFiles())
        return table

    def outer():
        first = shared.staged_alone(inner, "first")
        names.extend(first.inputFiles())
        return first.unionAll(shared.staged(spark.range(2), "second"))

    result = shared.staged_alone(outer, "result")
    there = lambda files: [os.path.exists(name.removeprefix("file://")) for name in files]
    assert result.count() == 5 and all(there(result.inputFiles())) and not any(there(names))

    def failing():
        names.append(shared.staged(spark.range(1), "left").inputFiles()[0])
        raise RuntimeError("stop")

    with pytest.raises(RuntimeError, match="stop"):
        shared.staged_alone(failing, "never")
    assert not any(there(names))
    kept = shared.staged(spark.range(1), "kept")
    assert all(there(kept.inputFiles()))


def test_staged_table_lies_in_the_shared_folder(spark):
    staged = shared.staged(spark.range(5).withColumn("date", F.lit("2019-02-01")), "five")
    assert staged.count() == 5 and dict(staged.dtypes)["date"] == "string"
    base = spark.conf.get("spark.checkpoint.dir")
    assert all(base in name for name in staged.inputFiles())


def test_cluster_without_shared_folder_is_refused(spark):
    class Context:
        @staticmethod
        def getCheckpointDir():
            return None

    class Conf:
        @staticmethod
        def get(name, default):
            return default

    class Session:
        sparkContext = Context
        conf = Conf

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(Session, "x")


@pytest.fixture
def saved(spark):
    found = {}

    def save(name, df):
        found.setdefault(name, []).extend(map(tuple, df.collect()))

    save.found = found
    return save


def test_session_job(spark, saved):
    jobs.session_job(log_of(spark, EDGE), edge_users(spark), PARAMS, "t", saved)
    found = saved.found
    assert found["session_aggr_stat"][0][:2] == ("t", 2)
    assert set(found["session_random_extract"]) == {
        ("t", "A", "2019-02-01 09:59:58", "hotpot,new hotpot", "1,11"),
        ("t", "B", "2019-02-01 09:00:00", None, None),
    }
    assert sorted(found["top10_category"]) == [("t", 1, 1, 0, 0), ("t", 3, 0, 1, 0), ("t", 7, 0, 2, 0),
                                               ("t", 11, 1, 0, 0)]
    assert set(found["top10_session"]) == {("t", 1, "A", 1), ("t", 11, "A", 1)}
    assert sorted(row[2] for row in found["session_detail"]) == ["A"] * 8 + ["B"]


def test_page_job(spark, saved):
    jobs.page_job(log_of(spark, EDGE), PARAMS, "t", saved)
    assert saved.found == {"page_split_convert_rate": [("t", "1_2=0.5|2_3=1.0")]}


def test_product_job(spark, saved):
    rows = [action("s", 1, i, product=p, city=c) for i, (p, c) in enumerate([(1, 1), (1, 2), (2, 1), (3, 0)])]
    products = spark.createDataFrame(
        [(i, f"p{i}", f'{{"product_status": {i % 2}}}') for i in range(4)], PRODUCT_INFO
    )
    jobs.product_job(log_of(spark, rows), city_dimension(spark), products, AREA_LEVELS, PARAMS, "t", saved)
    assert set(saved.found["area_top3_product"]) == {
        ("t", "华东", "A Level", 1, "1:上海,2:南京", 2, "p1", "Third Party"),
        ("t", "华东", "A Level", 2, "1:上海", 1, "p2", "Self"),
        ("t", "华北", "A Level", 3, "0:北京", 1, "p3", "Third Party"),
    }
