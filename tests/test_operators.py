"""Unit tests of single operators on small hand-made frames."""

import datetime as dt
import math
import random
import struct
from collections import Counter
from fractions import Fraction

from pyspark.sql import functions as F

from sensorstream.functions.math import order_bits
from sensorstream.operators import filters as FL
from sensorstream.operators import latest as LW
from sensorstream.operators import timeseries as TS
from sensorstream.operators import topn as TN
from sensorstream.operators.anomalies import anomalies
from sensorstream.plans.sql import split_statements
from sensorstream.sources import bus as B
from sensorstream.streaming.windows import event_time, guard_future


def _t(m, s=0):
    return dt.datetime(2024, 1, 1, 0, m, s)


def test_kafka_options_map_start_positions():
    o = B.kafka_options(["a", "b"], "k:9092", "earliest", group_id="g")
    assert o["subscribe"] == "a,b" and o["startingOffsets"] == "earliest" and o["kafka.group.id"] == "g"
    o = B.kafka_options("a", "k:9092", dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc), streaming=False)
    assert o["startingTimestamp"] == "1704067200000" and o["endingOffsets"] == "latest"


def test_file_replay_topics_and_start(spark, tmp_path):
    env = spark.createDataFrame(
        [(None, b"x", "a", 0, 0, _t(0)), (None, b"y", "b", 0, 1, _t(1)), (None, b"z", "a", 0, 2, _t(2))],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    env.write.parquet(str(tmp_path / "bus"))
    df = B.read_bus(spark, ["a"], "parquet", str(tmp_path / "bus"), start="2024-01-01T00:01:00", streaming=False)
    assert [r["offset"] for r in df.collect()] == [2]
    both = B.read_bus(spark, ["a", "b"], "parquet", str(tmp_path / "bus"), streaming=False)
    assert both.count() == 3
    future = B.select_envelope(env, None, "latest")
    assert future.count() == 0


def test_route_unknown_modes(spark):
    df = spark.createDataFrame([("t1",), ("t2",), ("zz",)], "topic string")
    tagged = FL.route(df, {"t1": "one", "t2": "two"})
    assert sorted(r["route"] for r in tagged.collect()) == ["one", "rejected", "two"]
    assert FL.route(df, {"t1": "one"}, on_unknown="drop").count() == 1
    parts = FL.split_routes(tagged, ["one", "two", "rejected"])
    assert parts["rejected"].first()["topic"] == "zz"


def test_match_labels_missing_is_empty_and_regex(spark):
    df = spark.createDataFrame([({"ns": "x", "c": "POD"},), ({"ns": "x"},), ({"ns": "x", "c": "app"},)],
                               "labels map<string,string>")
    keep = FL.match_labels(df, eq={"ns": "x"}, ne={"c": "POD"})
    keep = FL.match_labels(keep, ne={"c": ""})
    assert [r["labels"]["c"] for r in keep.collect()] == ["app"]
    assert FL.match_labels(df, re={"c": "P.D"}).count() == 1
    assert FL.match_labels(df, nre={"c": "P.D|app"}).count() == 1


def test_latest_wins_strategies_agree_and_break_ties(spark):
    df = spark.createDataFrame([("k", 1, 5.0), ("k", 2, 1.0), ("k", 2, 3.0), ("j", 1, None)],
                               "key string, o int, v double")
    a = sorted(tuple(r) for r in LW.latest_wins(df, "key", "o", "aggregate").collect())
    w = sorted(tuple(r) for r in LW.latest_wins(df, "key", "o", "window").collect())
    assert a == w == [("j", 1, None), ("k", 2, 3.0)]


def test_latest_n_and_head(spark):
    df = spark.range(10).select(F.lit("d").alias("k"), F.col("id").alias("o"))
    assert [r["o"] for r in TN.latest_n(df, "k", "o", 3).orderBy(F.desc("o")).collect()] == [9, 8, 7]
    assert [r["o"] for r in TN.latest_n(df, None, "o", 2).collect()] == [9, 8]
    assert [r["o"] for r in TN.head(df, 2, "o").collect()] == [0, 1]


def test_counter_rate_reset_and_bucket_edges(spark):
    # one series, samples every 60 s; reset at 04:00; buckets of 5 minutes = range
    vals = [0, 10, 20, 30, 5, 15, 25]
    df = spark.createDataFrame([("s", _t(i), float(v)) for i, v in enumerate(vals)], "sid string, ts timestamp, value double")
    got = {r["ts"]: r["rate"] for r in TS.counter_rate(df, "sid", range_="5 minutes", bucket="5 minutes").collect()}
    # increments: 0,10,10,10,5(reset),10,10 ; frame (t-300s, t] holds 5 samples,
    # the first of them is the baseline
    inc = [0, 10, 10, 10, 5, 10, 10]
    for i in range(len(vals)):
        want = sum(inc[max(0, i - 4) + 1: i + 1]) / 300.0
        assert abs(got[_t(i)] - want) < 1e-12, i


def test_counter_rate_bucket_size_does_not_change_result(spark):
    rows = [("s", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=7 * i), float((i * 3) % 40)) for i in range(400)]
    df = spark.createDataFrame(rows, "sid string, ts timestamp, value double")
    base = {r["ts"]: r["rate"] for r in TS.counter_rate(df, "sid", range_="1 minute", bucket="100 days").collect()}
    for b in ("1 minute", "2 minutes", "7 minutes"):
        other = {r["ts"]: r["rate"] for r in TS.counter_rate(df, "sid", range_="1 minute", bucket=b).collect()}
        assert other == base, b


def test_counter_rate_of_dense_fractions_with_resets(spark):
    """Dense samples of odd fractions, many resets, repeated moments, no readings: exact sums, any bucket."""
    rng = random.Random(5)
    odd = [float("nan"), float("inf"), None]
    rows = [("s" if i % 3 else "t", dt.datetime(2024, 1, 1) + dt.timedelta(milliseconds=20 * (i - i % 2)),
             odd[i % 3] if i % 50 == 7 else round(rng.random() * 10 ** (i % 4), 3)) for i in range(3000)]
    df = spark.createDataFrame(rows, "sid string, ts timestamp, value double")
    got = {}
    for bucket in ("2 seconds", "5 seconds", "1 hour"):
        out = TS.counter_rate(df, "sid", range_="2 seconds", bucket=bucket)
        assert out.columns == ["sid", "ts", "value", "rate"]
        got[bucket] = Counter((r.sid, r.ts, repr(r.value), repr(r.rate)) for r in out.collect())
    assert got["2 seconds"] == got["5 seconds"] == got["1 hour"]
    want = Counter()
    for sid in "st":
        known = sorted((t, v) for s, t, v in rows if s == sid and v is not None and math.isfinite(v))
        for s, t, v in rows:
            if s == sid:
                frame = [Fraction(repr(x)) for at, x in known if t - dt.timedelta(seconds=2) < at <= t]
                gain = sum((b - a if b >= a else b for a, b in zip(frame, frame[1:])), Fraction(0))
                want[sid, t, repr(v), round(float(gain / 2), 6) if frame else None] += 1
    assert Counter({(s, t, v, None if r == "None" else round(float(r), 6)): n for (s, t, v, r), n in got["1 hour"].items()}) == want


def test_gauge_at_and_sum_by(spark):
    df = spark.createDataFrame([("a", "p", _t(0, 10), 1.0), ("a", "p", _t(0, 50), 2.0), ("b", "p", _t(0, 30), 4.0),
                                ("b", "p", _t(1, 30), 8.0)], "sid string, pod string, ts timestamp, value double")
    g = {r["sid"]: r["value"] for r in TS.gauge_at(df, "sid", "2024-01-01 00:01:00").collect()}
    assert g == {"a": 2.0, "b": 4.0}
    s = {r["step_ts"]: r["value"] for r in TS.sum_by(df, "pod", "sid", "1 minute").collect()}
    assert s == {_t(1): 6.0, _t(2): 8.0}


def test_record_time_and_future_guard(spark):
    df = spark.createDataFrame([(_t(0), _t(5)), (_t(0), _t(0))], "timestamp timestamp, ts timestamp")
    rt = event_time(df, "record", out="event_ts")
    assert [r["event_ts"] for r in rt.collect()] == [_t(0), _t(0)]
    g = guard_future(df.withColumnRenamed("timestamp", "record_ts"), "ts", "record_ts", "1 minute")
    assert [r["reject_reason"] for r in g.collect()] == ["future_time", None]


def test_split_statements():
    assert split_statements("CREATE x AS 'a;b'; SELECT 1 ;\n") == ["CREATE x AS 'a;b'", "SELECT 1"]


def test_with_column_and_not_null(spark):
    from sensorstream.operators import decode as D
    df = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    out = D.with_column(df, "c", "a * 10")
    assert [r["c"] for r in out.orderBy("a").collect()] == [10, 20]
    assert [r["a"] for r in D.not_null(out, ["a", "b"]).collect()] == [2]
    assert D.project(out, {"x": "c"}).columns == ["x"]


def test_table_partition_pruning(spark, tmp_path):
    from sensorstream.plans import checks as C
    from sensorstream.sources import tables as TB
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("d1", _t(0), "2024-01-01", 1.0), ("d2", _t(1), "2024-01-02", 2.0)],
                               "device_id string, ts timestamp, dt string, v double")
    TB.create_table_if_absent(spark, path, df.schema, ["device_id", "ts"], partition_by=["dt"])
    TB.upsert_table(df, path, 0)
    v = TB.read_table(spark, path).filter("dt = '2024-01-02'")
    assert [r["device_id"] for r in v.collect()] == ["d2"]
    scan = [ln for ln in C.plan_text(v).splitlines() if "FileScan" in ln]
    assert scan and all("PartitionFilters: [isnotnull(dt" in ln for ln in scan)


def test_encode_write_read_bus_round_trip(spark, tmp_path):
    from sensorstream.functions.json import from_json_col
    from sensorstream.schemas import WINDOW_AVG_MESSAGE
    from sensorstream.streaming import sinks as S
    win = spark.createDataFrame([("d1", _t(0), _t(1), 21.25)],
                                "device_id string, window_start timestamp, window_end timestamp, avg_temp double")
    msgs = B.encode_messages(win, ["device_id", "window_start", "window_end", "avg_temp"], "iot_windowed_data",
                             time_col="window_end")
    B.write_bus(msgs, "iot_windowed_data", "parquet", str(tmp_path / "topic"))
    S.envelope_sink(str(tmp_path / "topic2"))(msgs, 7)
    for path in (tmp_path / "topic", tmp_path / "topic2"):
        back = B.read_bus(spark, "iot_windowed_data", "parquet", str(path), streaming=False)
        r = back.select(from_json_col(F.col("value").cast("string"), WINDOW_AVG_MESSAGE).alias("m")).first()["m"]
        assert (r["device_id"], r["window_start"], r["avg_temp"]) == ("d1", "2024-01-01 00:00:00.000", 21.25)
        assert back.first()["timestamp"] == _t(1)


def test_declare_stream_and_sql_script(spark):
    from sensorstream.plans.sql import run_sql
    from sensorstream.sources.catalog import declare_stream
    raw = spark.createDataFrame([("d", "2024-01-01 00:00:10.000", 1.0), ("d", "2024-01-01 00:00:50.000", 3.0),
                                 ("d", "not a time", 9.0)], "device_id string, timestamp string, temperature double")
    declare_stream(spark, "readings_decl", raw, "ts",
                   time_expr="try_to_timestamp(timestamp, 'yyyy-MM-dd HH:mm:ss.SSS')")
    out = run_sql(spark, """
        CREATE OR REPLACE TEMP VIEW readings_ok AS SELECT * FROM readings_decl WHERE ts IS NOT NULL;
        SELECT device_id, window.start AS ws, avg(temperature) AS a
        FROM readings_ok GROUP BY device_id, window(ts, '1 minute');""")
    assert [tuple(r) for r in out.collect()] == [("d", _t(0), 2.0)]


def test_interval_units_and_script_comments():
    assert [TS.interval_ms(t) for t in ("5 minutes", "1 h", "2 hours", "30 s", "1 day", "250 ms", "3 mins")] == \
        [300_000, 3_600_000, 7_200_000, 30_000, 86_400_000, 250, 180_000]
    assert split_statements("SELECT 1; -- a; comment\nSELECT 2") == ["SELECT 1", "SELECT 2"]


def test_order_bits_are_those_of_the_double(spark):
    rng = random.Random(3)
    odd = [0.0, -0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, float("inf"), float("-inf"), 1.0, -1.0,
           2.0, 0.1, 1 / 3, math.nextafter(1, 0), math.nextafter(8, 0), math.nextafter(2.0 ** -40, 0), 2.0 ** 52 + 1]
    odd += [math.nextafter(2.0 ** e, d) for e in range(-1022, 1023, 31) for d in (0, math.inf)] + [2.0 ** e for e in range(-1074, 1024, 13)]
    odd += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(500)]
    values = [v for v in odd if v == v] + [-v for v in odd if v == v] + [float("nan")]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", order_bits(F.col("v")).alias("b")).collect()
    for r in got:
        bits = struct.unpack("<q", struct.pack("<d", abs(r.v)))[0]
        assert r.b == (-bits if r.v < 0 else bits), r.v
    assert spark.sql("SELECT CAST(NULL AS DOUBLE) AS v").select(order_bits(F.col("v"))).first()[0] is None


def test_newest_value_is_a_hash_aggregate(spark):
    rows = [("s", _t(0, i % 7), v) for i, v in enumerate([3.0, -1.0, None, 0.5, -2.5, float("nan"), 7.0, 1.0, 2.0, 4.0, -9.0, -3.0, None, None, 8.0])]
    df = spark.createDataFrame(rows, "sid string, ts timestamp, value double")
    for made in (TS.gauge_at(df, "sid", "2024-01-01 00:01:00"), TS.at_steps(df, "sid")):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan
    for at, want in ((0, 8.0), (1, 2.0), (2, 4.0), (3, 0.5), (4, -2.5), (5, "nan"), (6, 7.0)):       # nulls are below, NaN above
        got = TS.gauge_at(df.filter(F.second("ts") <= at), "sid", "2024-01-01 00:01:00").collect()[0]
        assert (got.ts, str(got.value)) == (_t(0, at), str(want))
    assert TS.gauge_at(df.filter("value IS NULL"), "sid", "2024-01-01 00:01:00").collect()[0].value is None


def test_anomalies_split_by_history(spark):
    """Gaps, buckets of fewer rows than the history, buckets without rows, several keys: as unsplit."""
    rng = random.Random(9)
    rows = [(k, t, float(rng.randrange(1000)) if t % 11 else None) for k in "abc" for t in sorted(rng.sample(range(400), 120))]
    rows += [("d", 5, 1.0), (None, 7, 2.0), (None, 300, 2.0)]
    win = spark.createDataFrame(rows, "device_id string, window_start long, avg_temp double").repartition(4)
    want = sorted(map(tuple, anomalies(win).collect()), key=repr)
    for bucket in (1, 7, 50, 1000):
        assert sorted(map(tuple, anomalies(win, bucket=bucket).collect()), key=repr) == want
    timed = win.withColumn("window_start", F.timestamp_seconds(F.col("window_start") * 60))
    assert Counter(r.is_anomaly for r in anomalies(timed, bucket="20 minutes").collect()) == Counter(w[-1] for w in want)
    plan = anomalies(win, bucket=50)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
