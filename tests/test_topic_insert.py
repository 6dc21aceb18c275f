"""INSERT INTO a declared topic."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sensorstream.plans.sql import run_sql
from sensorstream.sources import bus as B
from sensorstream.sources.catalog import declare_stream, declare_topic

COLUMNS = "device_id STRING, n INT, at TIMESTAMP"


def messages(spark, path, topic):
    return sorted(r[0] for r in B.read_bus(spark, topic, "parquet", path, streaming=False)
                  .select(F.col("value").cast("string")).collect())


def declare(tmp_path, name="target", schema=COLUMNS, **options):
    path = str(tmp_path / name)
    declare_topic(name, schema, str(tmp_path / f"{name}-ck"), path=path, **options)
    return path


def test_batch_by_position_and_by_name(spark, tmp_path):
    path = declare(tmp_path)
    run_sql(spark, """INSERT INTO target SELECT 'a' AS x, 1L AS x, TIMESTAMP '2031-01-01 00:00:00.123456' AS device_id;
                      INSERT INTO target (n, device_id) SELECT 2, 'b';
                      insert into table `target` (at) WITH t AS (SELECT 1) SELECT DATE '2031-01-02' FROM t""")
    assert [json.loads(m) for m in messages(spark, path, "target")] == [
        {"device_id": "a", "n": 1, "at": "2031-01-01 00:00:00.123"}, {"device_id": "b", "n": 2, "at": None},
        {"device_id": None, "n": None, "at": "2031-01-02 00:00:00.000"}]


@pytest.mark.parametrize("statement, said", [
    ("INSERT INTO target SELECT 'a', 1", "2 columns for 3"),
    ("INSERT INTO target SELECT 'a', 1, current_timestamp(), 4", "4 columns for 3"),
    ("INSERT INTO target SELECT 'a', '1', current_timestamp()", "n: string into int"),
    ("INSERT INTO target SELECT 'a', 1, 2", "at: int into timestamp"),
    ("INSERT INTO target SELECT array('a'), 1, current_timestamp()", "device_id: array<string> into string"),
    ("INSERT INTO target (n, m) SELECT 1, 2", "unknown"),
    ("INSERT INTO target (n, N) SELECT 1, 2", "repeated")])
def test_what_does_not_fit_raises(spark, tmp_path, statement, said):
    declare(tmp_path)
    with pytest.raises(ValueError, match=said):
        run_sql(spark, statement)


def test_range_and_null_fail_the_write(spark, tmp_path):
    declare(tmp_path, schema="n INT NOT NULL")
    for value in ("3000000000L", "CAST(NULL AS INT)"):
        with pytest.raises(Exception, match="CAST_OVERFLOW|null in n"):
            run_sql(spark, f"INSERT INTO target SELECT {value}")


def test_declaration_is_checked(tmp_path):
    for options in ({"format": "kafka", "path": "x"}, {}, {"path": "x", "time_col": "nope"}, {"path": "x", "key_col": "nope"}):
        with pytest.raises(ValueError):
            declare_topic("bad", "a INT", str(tmp_path), **options)


def test_stream_sends_each_window_once(spark, tmp_path):
    """Key and record time come from columns; a window waits for the watermark, over a restart too."""
    t0 = dt.datetime(2031, 1, 1)
    path = declare(tmp_path, "out", "device_id STRING, window_end TIMESTAMP, n BIGINT", key_col="device_id", time_col="window_end",
                   topic="counts")
    sent = []
    for k, seconds in enumerate([[1, 2], [70], [3, 130], [400]]):
        rows = [("d", t0 + dt.timedelta(seconds=s)) for s in seconds]
        spark.createDataFrame(rows, "device_id string, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "in" / f"k={k}"))
        stream = spark.readStream.schema("device_id string, ts timestamp").parquet(str(tmp_path / "in" / "*"))
        declare_stream(spark, "src", stream, "ts", watermark="5 seconds")
        q = run_sql(spark, "INSERT INTO out SELECT device_id, window.end, count(*) FROM src GROUP BY device_id, window(ts, '1 minute')")
        q.awaitTermination()
        assert q.exception() is None
        sent.append(sorted(json.loads(m)["n"] for m in messages(spark, path, "counts")))
    assert sent == [[], [2], [1, 2], [1, 1, 2]]                # the late third second is dropped
    got = B.read_bus(spark, "counts", "parquet", path, streaming=False).select(F.col("key").cast("string"), "timestamp").collect()
    assert sorted(map(tuple, got)) == [("d", t0 + dt.timedelta(minutes=m)) for m in (1, 2, 3)]


def test_aggregate_without_watermark_is_refused(spark, tmp_path):
    declare(tmp_path, schema="n BIGINT")
    spark.range(1).selectExpr("timestamp_seconds(id) AS ts").write.parquet(str(tmp_path / "in"))
    declare_stream(spark, "src2", spark.readStream.schema("ts timestamp").parquet(str(tmp_path / "in")))
    with pytest.raises(Exception, match="(?i)watermark"):
        run_sql(spark, "INSERT INTO target SELECT count(*) FROM src2 GROUP BY window(ts, '1 minute')")
