"""The ten decode cases of FIXTURES.md section 3, and reject reasons."""

import datetime as dt


from sensorstream.functions.time import parse_any_ts, parse_iso_ts, parse_sql_ts
from sensorstream.operators import decode as D

FULL = '{"device_id":"device-1","timestamp":"%s","temperature":%s,"humidity":55.5,"status":"OK"}'

CASES = [
    (1, FULL % ("2025-11-24 19:35:48.012", "21.5")),
    (2, "not json"),
    (3, '{"device_id":"device-1"}'),
    (4, '{"device_id":"d","timestamp":"2025-11-24T18:28:25.155390","temperature":"abc"}'),
    (5, '{"device_id":"d","timestamp":"2025-11-05T12:00:00Z","temperature":30}'),
    (6, "[1]"),
    (7, ""),
    (8, "null"),
    (9, FULL % ("2025-11-24 19:35:48.01", "20")),
    (10, '{"device_id":"d","timestamp":"2025-11-24 19:35:48.155390","temperature":"31.5"}'),
]


def _decoded(spark):
    env = spark.createDataFrame(CASES, "offset long, value string")
    d = D.decode_readings(env, time_mode="sql")
    return {r["offset"]: r for r in d.withColumn("lenient", parse_iso_ts("timestamp"))
            .withColumn("anyform", parse_any_ts("timestamp")).collect()}


def test_reasons(spark):
    r = _decoded(spark)
    assert r[1][D.REASON] is None
    assert r[1]["ts"] == dt.datetime(2025, 11, 24, 19, 35, 48, 12000)
    assert r[2][D.REASON] == "malformed_json"
    assert r[3][D.REASON] == "missing_timestamp"
    assert r[4][D.REASON] == "bad_temperature"        # "abc" is not a number
    assert r[5][D.REASON] == "bad_time"               # ISO form under the strict SQL parse
    assert r[5]["temperature"] == 30.0
    assert r[6][D.REASON] == "malformed_json"
    assert r[7][D.REASON] == "malformed_json"
    assert r[8][D.REASON] == "malformed_json"
    assert r[9][D.REASON] is None and r[9]["ts"] == dt.datetime(2025, 11, 24, 19, 35, 48, 10000)
    assert r[10]["temperature"] == 31.5               # quoted number accepted like float()
    assert r[10][D.REASON] == "bad_time"              # six fraction digits: strict parse fails


def test_time_parsers(spark):
    df = spark.createDataFrame([("2025-11-24 19:35:48.012",), ("2025-11-24T18:28:25.155390",),
                                ("2025-11-05T12:00:00Z",), ("2025-11-24 19:35:48.155390",),
                                ("2025-11-24 19:35:48",), ("garbage",)], "t string")
    rows = df.select(parse_sql_ts("t").alias("s"), parse_iso_ts("t").alias("i"),
                     parse_any_ts("t").alias("a")).collect()
    assert rows[0]["s"] == rows[0]["i"] == rows[0]["a"]
    assert rows[1]["s"] is None and rows[1]["i"] == dt.datetime(2025, 11, 24, 18, 28, 25, 155390)
    assert rows[2]["s"] is None and rows[2]["i"] == dt.datetime(2025, 11, 5, 12, 0, 0)
    assert rows[3]["s"] is None and rows[3]["a"] == dt.datetime(2025, 11, 24, 19, 35, 48, 155390)
    assert rows[4]["a"] == dt.datetime(2025, 11, 24, 19, 35, 48)
    assert rows[5]["s"] is None and rows[5]["i"] is None and rows[5]["a"] is None


def test_require_event_time_modes(spark):
    df = spark.createDataFrame([(1, None), (2, dt.datetime(2025, 1, 1))], "id int, ts timestamp")
    assert D.require_event_time(df, "ts", "drop").count() == 1
    q = D.require_event_time(df, "ts", "quarantine")
    assert [r[D.REASON] for r in q.orderBy("id").collect()] == ["null_time", None]
    failing = D.require_event_time(df, "ts", "fail")
    try:
        failing.collect()
        raise AssertionError("expected a failure")
    except Exception as e:  # noqa: BLE001
        assert "without event time" in str(e)


def test_encode_keeps_nulls(spark):
    from sensorstream.functions.json import to_json_col
    df = spark.createDataFrame([("d", None, dt.datetime(2025, 1, 2, 3, 4, 5, 678901))],
                               "device_id string, avg_temp double, window_start timestamp")
    s = df.select(to_json_col(["device_id", "window_start", "avg_temp"]).alias("j")).first()["j"]
    assert s == '{"device_id":"d","window_start":"2025-01-02 03:04:05.678","avg_temp":null}'


def test_safe_avg_zero(spark):
    from sensorstream.functions.math import safe_avg
    df = spark.createDataFrame([(10.0, 0), (10.0, 4)], "s double, n long")
    assert [r[0] for r in df.select(safe_avg("s", "n")).collect()] == [0.0, 2.5]


def test_null_time_policy_spares_rows_rejected_for_other_reasons(spark):
    env = spark.createDataFrame([(1, "not json"), (2, '{"device_id":"d","temperature":1}'),
                                 (3, FULL % ("2025-11-24 19:35:48.012", "21.5"))], "offset long, value string")
    kept = D.decode_readings(env, required=("device_id",), on_null_time="drop")
    assert sorted((r["offset"], r[D.REASON]) for r in kept.collect()) == [(1, "malformed_json"), (3, None)]
    failing = D.decode_readings(env.filter("offset <> 2"), required=("device_id",), on_null_time="fail")
    assert failing.count() == 2          # the malformed row does not trip the time policy


def test_future_readings_are_rejected_not_watermarked(spark):
    rows = [(1, FULL % ("2025-11-24 19:35:48.012", "21.5"), dt.datetime(2025, 11, 24, 19, 35, 49)),
            (2, FULL % ("2031-01-01 00:00:00.000", "21.5"), dt.datetime(2025, 11, 24, 19, 35, 49))]
    env = spark.createDataFrame(rows, "offset long, value string, timestamp timestamp")
    d = D.decode_readings(env, max_skew="1 hour")
    assert {r["offset"]: r[D.REASON] for r in d.collect()} == {1: None, 2: "future_time"}
    assert "record_ts" not in d.columns
