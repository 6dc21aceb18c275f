"""Findings of the review: each case that was lost, accepted or wrong."""

import json
import time

import pytest
from pyspark.sql import functions as F

from sensorstream.functions.math import exact_mean
from sensorstream.functions.time import parse_any_ts, parse_iso_ts
from sensorstream.operators import decode as D
from sensorstream.operators.anomalies import anomalies
from sensorstream.operators import timeseries as TS
from sensorstream.plans import jobs as J
from sensorstream.plans.sql import run_sql, tumbling_avg_sql
from sensorstream.sources import tables as TB
from sensorstream.sources.bus import kafka_options
from sensorstream.sources.catalog import declare_sink
from sensorstream.streaming.runner import ProgressTotals


def test_two_writers_and_a_new_one_after_compaction(spark, tmp_path):
    path = str(tmp_path / "t")
    row = lambda k, v: spark.createDataFrame([(k, v)], "k string, v int")
    TB.upsert_table(row("a", 1), path, 0, keys="k", writer="one")
    TB.upsert_table(row("b", 2), path, 0, writer="two")
    TB.upsert_table(row("a", 3), path, 1, writer="one")
    TB.upsert_table(row("a", 3), path, 1, writer="one")
    want = {"a": 3, "b": 2}
    read = lambda: {r.k: r.v for r in TB.read_table(spark, path).collect()}
    assert read() == want
    assert TB.compact(spark, path).generation == 1
    assert read() == want
    TB.upsert_table(row("c", 4), path, 0, writer="three")
    assert read() == want | {"c": 4}


def test_new_writer_updates_a_key(spark, tmp_path):
    row = lambda v, at: spark.createDataFrame([("a", v, at)], "k string, v int, at long")
    for order in (["at"], []):
        path = str(tmp_path / f"t{len(order)}")
        read = lambda: [r.v for r in TB.read_table(spark, path).collect()]  # noqa: E731, B023
        TB.upsert_table(row(1, 100), path, 57, keys="k", order=order, writer="old")
        TB.upsert_table(row(2, 200), path, 0, writer="new")       # a later record, a lower batch
        assert read() == [2]
        TB.upsert_table(row(1, 100), path, 57, writer="old")      # a replay stays where it was
        assert read() == [2]
        for w, n in (("old", 58), ("new", 1)):                    # so that compaction folds both
            TB.upsert_table(row(0, 0).where("false"), path, n, writer=w)
        TB.compact(spark, path)
        assert read() == [2]
        TB.upsert_table(row(3, 150), path, 0, writer="third")     # an earlier record, the last write
        assert read() == ([2] if order else [3])


def test_replay_replaces_whole_batch_and_snapshot_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = lambda *r: spark.createDataFrame(list(r), "k string, dt string, v int")
    m = TB.create_table_if_absent(spark, path, df(("a", "x", 1)).schema, "k", partition_by=["dt"])
    TB.upsert_table(df(("a", "x", 1), ("b", "y", 2)), path, 0, manifest=m)
    TB.upsert_table(df(("a", "x", 5)), path, 0, manifest=m)
    assert [r.k for r in TB.read_table(spark, path).collect()] == ["a"]
    TB.upsert_table(df(("c", "z", 1)), path, 1, manifest=m)
    assert TB.compact(spark, path).generation == 1
    plan = TB.read_table(spark, path).filter("dt = 'x'")._jdf.queryExecution().toString()
    assert plan.count("PartitionFilters: [isnotnull(dt") >= 2
    assert TB.read_table(spark, path).filter("dt = 'x'").count() == 1


def test_unreadable_store_raises(spark):
    with pytest.raises(Exception, match="foo"):
        TB.read_manifest(spark, "foo://nowhere/table")


def test_mean_of_odd_values(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 10D), (1, 20D), (1, double('NaN')), (2, 1e30D), (2, 1e30D), (3, 1.1D), (3, NULL) AS t(k, v)")
    got = {r.k: r.m for r in df.groupBy("k").agg(exact_mean("v", 2).alias("m")).collect()}
    assert got[1] != got[1] and got[2] == 1e30 and got[3] == 1.1


def test_coerce_rejects_what_is_no_reading(spark):
    texts = ["31.5", "abc", "NaN", "Infinity", "1e30", "31.5d", "31.5f", "31.5d\t", "0x1p3", "-4e1", None]
    df = spark.createDataFrame([(t,) for t in texts], "temperature string")
    got = D.coerce(df, {"temperature": "double"}).collect()
    assert [r.reject_reason for r in got] == [None] + ["bad_temperature"] * 8 + [None, None]
    assert [r.temperature for r in got] == [31.5, *[None] * 8, -40.0, None]


def test_iso_shape(spark):
    texts = ["2031-05-06T07:08:09Z", "2031-05-06 07:08:09.123456", "2031-05-06T09:08:09+02:00", "12:30:45", "T12:30", "2031", "2031-05",
             "2031-5-6", "garbage", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        F.unix_seconds(parse_iso_ts("t")).alias("iso"), F.unix_seconds(parse_any_ts("t")).alias("any")).collect()
    assert len({r.iso for r in got[:3]}) == 1 and got[0].iso is not None
    assert all(r.iso is None and r["any"] is None for r in got[3:])


def test_anomaly_flag_on_unrounded_values(spark):
    rows = [("d", i, 1e-7 * (1 + 0.01 * (i % 2))) for i in range(12)]
    got = anomalies(spark.createDataFrame(rows, "device_id string, window_start int, avg_temp double")).collect()
    assert not any(r.is_anomaly for r in got)


def test_general_sql_mean_and_bus_options():
    assert "AVG(temperature)" in tumbling_avg_sql() and "DECIMAL(28,2)" in tumbling_avg_sql(exact_scale=2)
    o = kafka_options("t", "b:1", "latest", streaming=False)
    assert o["failOnDataLoss"] == "true" and "startingOffsets" not in o and o["startingTimestamp"].isdigit()


def _bus(spark, rows):
    """Envelope rows: (value, topic, partition, offset, record time)."""
    return (spark.createDataFrame(rows, "value string, topic string, partition int, offset long, timestamp string")
            .withColumn("value", F.encode("value", "UTF-8")).withColumn("timestamp", F.to_timestamp("timestamp")))


def _stream(spark, env, path):
    env.coalesce(1).write.parquet(path)
    return spark.readStream.schema(env.schema).parquet(path)


def _reading(ts="2031-05-06 07:08:09.000", **other):
    fields = {"device_id": "d", "timestamp": ts, "temperature": 1.5, "humidity": 2.0, "status": "OK"} | other
    return json.dumps({k: v for k, v in fields.items() if v is not None})


def test_newest_bus_record_wins_across_partitions(spark, tmp_path):
    env = _bus(spark, [(_reading(temperature=1.0), "t", 0, 900, "2031-05-06 07:08:10"),
                       (_reading(temperature=2.0), "t", 1, 5, "2031-05-06 07:09:10")])
    J.readings_to_tables(_stream(spark, env, str(tmp_path / "in")), str(tmp_path / "raw"), str(tmp_path / "bad"),
                         str(tmp_path / "ck")).awaitTermination()
    assert [r.temperature for r in TB.read_table(spark, str(tmp_path / "raw")).collect()] == [2.0]


def test_null_time_policy_acts_on_absent_and_unreadable_times(spark):
    env = _bus(spark, [(_reading(ts=t), "t", 0, i, "2031-05-06 07:08:10")
                       for i, t in enumerate(["2031-05-06 07:08:09.000", None, "garbage"])])
    assert [r.offset for r in D.decode_readings(env, on_null_time="drop").collect()] == [0]
    reasons = [r[D.REASON] for r in D.decode_readings(env).orderBy("offset").collect()]
    assert reasons == [None, "missing_timestamp", "bad_time"]
    with pytest.raises(Exception, match="row without event time"):
        D.decode_readings(env, on_null_time="fail").collect()


def test_fail_policy_stops_the_windowed_job(spark, tmp_path):
    env = _bus(spark, [(_reading(ts=None), "t", 0, 0, "2031-05-06 07:08:10")])
    q = J.windowed_averages(_stream(spark, env, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"),
                            on_null_time="fail", state_partitions=1)
    with pytest.raises(Exception, match="row without event time"):
        q.awaitTermination()


def test_routed_consumer_wants_whole_records(spark, tmp_path):
    def avg(**other):
        fields = {"device_id": "d", "window_start": "2031-05-06 07:08:00.000", "window_end": "2031-05-06 07:09:00.000",
                  "avg_temperature": 3.5} | other
        return json.dumps({k: v for k, v in fields.items() if v is not None})
    values = [(_reading(), "r"), (_reading(humidity=None), "r"), (_reading(status=None), "r"), (avg(), "a"),
              (avg(window_end=None), "a"), (avg(window_end="soon"), "a"), ("not json", "a"), (_reading(), "x")]
    env = _bus(spark, [(v, t, 0, i, "2031-05-06 07:08:10") for i, (v, t) in enumerate(values)])
    J.route_topics_to_tables(_stream(spark, env, str(tmp_path / "in")), str(tmp_path / "raw"), str(tmp_path / "avg"),
                             str(tmp_path / "bad"), str(tmp_path / "ck"), readings_topic="r",
                             averages_topic="a").awaitTermination()
    assert TB.read_table(spark, str(tmp_path / "raw")).count() == 1
    assert TB.read_table(spark, str(tmp_path / "avg")).count() == 1
    bad = spark.read.parquet(str(tmp_path / "bad")).orderBy("offset").collect()
    assert [(r.offset, r[D.REASON]) for r in bad] == [
        (1, "missing_humidity"), (2, "missing_status"), (4, "missing_window_end"), (5, "bad_time"),
        (6, "malformed_json"), (7, "unknown_topic")]


def test_counter_rate_skips_values_that_are_none(spark):
    nan, ts = float("nan"), "2031-01-01 00:0{}:00"
    values = [0.1, nan, 0.4, None, 0.2, 0.9]
    df = spark.createDataFrame([("s", ts.format(i), v) for i, v in enumerate(values)], "sid string, t string, value double")
    df = df.withColumn("ts", F.to_timestamp("t"))
    for bucket in ("3 minutes", "7 minutes", "1 hour"):
        got = [r.rate for r in TS.counter_rate(df, "sid", range_="3 minutes", bucket=bucket).orderBy("ts").collect()]
        step = (0.4 - 0.1) / 180.0
        assert got == [0.0, 0.0, step, 0.0, 0.2 / 180.0, (0.9 - 0.2) / 180.0]


def test_totals_outlive_the_recent_progress(spark, tmp_path):
    env = _bus(spark, [(_reading(), "t", 0, i, "2031-05-06 07:08:10") for i in range(6)])
    src = str(tmp_path / "in")
    env.repartition(6, "offset").write.option("maxRecordsPerFile", 1).parquet(src)
    stream = spark.readStream.schema(env.schema).option("maxFilesPerTrigger", 1).parquet(src)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        with ProgressTotals(spark) as totals:
            q = J.readings_to_tables(stream, str(tmp_path / "raw"), str(tmp_path / "bad"), str(tmp_path / "ck"),
                                     metrics_path=str(tmp_path / "metrics"))
            q.awaitTermination()
            end = time.time() + 20
            while totals.of("readings_to_tables").get("decode_counts_rows") != 6 and time.time() < end:
                time.sleep(0.1)
            assert totals.of("readings_to_tables")["numInputRows"] >= 6
            assert totals.of("readings_to_tables")["decode_counts_rows"] == 6
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    m = spark.read.parquet(str(tmp_path / "metrics"))
    assert m.where("metric = 'decoded_rows'").agg(F.sum("value")).first()[0] == 6.0


def test_sql_insert_of_a_batch(spark, tmp_path):
    declare_sink("batch_target", str(tmp_path / "t"), "k", str(tmp_path / "ck"))
    run_sql(spark, "INSERT INTO batch_target SELECT 1 AS k, 'old' AS v; INSERT INTO batch_target SELECT 1 AS k, 'new' AS v")
    assert [tuple(r) for r in TB.read_table(spark, str(tmp_path / "t")).collect()] == [(1, "new")]
