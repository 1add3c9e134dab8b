import json

import pytest

from clicktrail.plans.run import run
from clicktrail.schemas import PRODUCT_INFO
from clicktrail.sources.reports import table_overwrite
from tests.rows import EDGE, action, edge_users, log_of

PARAMS = json.dumps(
    {"startDate": "2019-02-01", "endDate": "2019-02-28", "startAge": 20, "endAge": 50, "professionals": "",
     "cities": "", "sex": "", "keywords": "", "categoryIds": "", "targetPageFlow": "1,2,3"}
)


@pytest.fixture(scope="module")
def catalog(spark):
    rows = EDGE[:2] + [action("A", 1, 3, 3, "2019-02-01 10:00:02")] + EDGE[3:]
    rows += [action("B", 2, 7, 2, product=4, city=2)]
    tables = {
        "user_visit_action": log_of(spark, rows).drop("action_seq"),
        "user_info": edge_users(spark),
        "product_info": spark.createDataFrame([(4, "p4", '{"product_status": 0}')], PRODUCT_INFO),
    }
    for name, df in tables.items():
        table_overwrite(df, name, catalog=True)
    yield spark
    for name in tables:
        spark.sql(f"DROP TABLE {name}")


def test_session_job_into_tables(catalog):
    for task in ("t1", "t2"):
        assert run(catalog, ["session", "--params", PARAMS, "--task-id", task]) == task
    stat = catalog.table("session_aggr_stat")
    assert sorted(r.taskid for r in stat.collect()) == ["t1", "t2"]
    for name in ("session_random_extract", "session_detail", "top10_category", "top10_session"):
        assert {r.taskid for r in catalog.table(name).collect()} == {"t1", "t2"}
        catalog.sql(f"DROP TABLE {name}")
    catalog.sql("DROP TABLE session_aggr_stat")


def test_page_job_into_files(catalog, tmp_path):
    task = run(catalog, ["page", "--params", PARAMS, "--format", "json", "--target", str(tmp_path)])
    found = catalog.read.json(str(tmp_path / "page_split_convert_rate")).first()
    assert (found.taskid, found.convertRate) == (task, "1_2=1.0|2_3=0.5")


def test_product_job_into_files(catalog, tmp_path):
    run(catalog, ["product", "--params", PARAMS, "--format", "parquet", "--target", str(tmp_path)])
    found = catalog.read.parquet(str(tmp_path / "area_top3_product")).drop("taskid").first()
    assert tuple(found) == ("华东", "A Level", 4, "2:南京", 1, "p4", "Self")


def test_levels_of_an_own_city_table(catalog, tmp_path):
    table_overwrite(catalog.createDataFrame([(2, "Rome", "South")], "city_id BIGINT, city_name STRING, area STRING"), "city_info", catalog=True)
    arguments = ["product", "--params", PARAMS, "--format", "parquet", "--target", str(tmp_path), "--levels", '{"South": "A Level"}']
    run(catalog, arguments)
    found = catalog.read.parquet(str(tmp_path / "area_top3_product")).first()
    assert tuple(found)[1:4] == ("South", "A Level", 4)
    catalog.sql("DROP TABLE city_info")


def test_times_are_utc(catalog, tmp_path, settings):
    settings(session__timeZone="America/New_York")
    run(catalog, ["page", "--params", PARAMS, "--format", "json", "--target", str(tmp_path)])
    assert catalog.conf.get("spark.sql.session.timeZone") == "UTC"


def test_stream_job(catalog, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    (incoming / "lines.txt").write_text("1546300800000 3 3 42 7\nbad\n")
    target = str(tmp_path / "out")
    run(catalog, ["stream", "--source", "text", "--option", f"path={incoming}", "--target", target, "--checkpoint", str(tmp_path / "state")])
    assert sorted(r.user_id or 0 for r in catalog.read.parquet(target).collect()) == [0, 42]
    with pytest.raises(SystemExit):
        run(catalog, ["stream"])
