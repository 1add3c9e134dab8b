from datetime import datetime, timezone

import pytest
from pyspark.errors import StreamingQueryException

from clicktrail.schemas import AD_CLICK
from clicktrail.streaming import ad_clicks

LINES = ["1546300800000 3 3 42 7", "bad line", "1546300800000 3 3 42", "1546300800000 3 3 42 7 9", "x 3 3 42 7",
         "", "1546300800123 0 0 0 0", "99999999999999999 1 1 1 1", "1546300800000 3  3 42 7"]


def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_decode(spark):
    df = spark.createDataFrame([(line,) for line in LINES], "value STRING")
    found = ad_clicks.ad_click_events(df)
    expected = [f.split()[:2] for f in AD_CLICK.strip().split(",")]
    assert [(n, t.upper()) for n, t in found.dtypes] == [(n, t) for n, t in expected]
    rows = found.collect()
    good = datetime(2019, 1, 1, tzinfo=timezone.utc)
    assert [r._corrupt for r in rows] == [None, *LINES[1:6], None, *LINES[7:]]
    text = found.selectExpr("CAST(ts AS STRING) ts", "province", "city", "user_id", "ad_id").collect()
    assert tuple(text[0]) == (good.strftime("%Y-%m-%d %H:%M:%S"), 3, 3, 42, 7)
    assert tuple(text[6]) == ("2019-01-01 00:00:00.123", 0, 0, 0, 0)
    assert all(value is None for value in text[1])


def test_times_before_1970_and_far_ahead(spark):
    df = spark.createDataFrame([("-1000 3 3 42 7",), ("253402300800000 1 1 1 1",), (f"{2**63 - 1} 1 1 1 1",)], "value STRING")
    found = ad_clicks.ad_click_events(df).selectExpr("unix_millis(ts) AS ms", "_corrupt").collect()
    assert [r.ms for r in found] == [-1000, 253402300800000, None]
    assert [r._corrupt is None for r in found] == [True, True, False]


def test_stream_equals_batch_and_survives_a_restart(spark, tmp_path):
    incoming, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    write_lines(incoming, "one.txt", LINES)

    def run():
        lines = ad_clicks.ad_click_source(spark, "text", path=str(incoming))
        ad_clicks.ad_click_stream(lines, target, state).awaitTermination()
        return sorted(map(str, spark.read.schema(AD_CLICK).parquet(target).collect()))

    def batch():
        lines = spark.read.text(str(incoming))
        return sorted(map(str, ad_clicks.ad_click_events(lines).collect()))

    assert run() == batch()
    write_lines(incoming, "two.txt", LINES[:3])
    assert run() == batch()
    assert len(run()) == len(LINES) + 3


def test_sinks_hold_each_line_once_after_a_restart(spark, tmp_path):
    """The first run fails after the valid lines were written; the second repeats that batch, a third has nothing to do."""
    incoming = tmp_path / "in"
    incoming.mkdir()
    (incoming / "a.txt").write_text("1546300800000 3 3 42 7\nbad\n\n1546300800001 1 1 43 8\n")
    clicks, corrupt = tmp_path / "clicks", tmp_path / "corrupt"
    corrupt.write_text("in the way")

    def run():
        lines = ad_clicks.ad_click_source(spark, "text", path=str(incoming))
        ad_clicks.ad_click_sinks(lines, str(clicks), str(corrupt), str(tmp_path / "state")).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    assert spark.read.parquet(str(clicks)).count() == 2
    corrupt.unlink()
    run()
    (incoming / "b.txt").write_text("1546300800002 1 1 44 8\nworse\n")
    run()
    run()
    assert sorted(r.user_id for r in spark.read.parquet(str(clicks)).collect()) == [42, 43, 44]
    assert sorted(r.value for r in spark.read.parquet(str(corrupt)).collect()) == ["", "bad", "worse"]
