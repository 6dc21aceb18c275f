"""Registered queries: one Spark callable and, where SQL can express it, one
DuckDB statement over the same Parquet tables (the correctness oracle).

Every query reads the driver's tables through the adapters in
``sources.fixtures``; nothing is sampled or capped except where a limit is
the operator itself (``latest_n``, ``head_n``).  Times leave Spark as
``timestamp_ntz`` (UTC wall time), the type DuckDB reports for the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.json import from_json_col, to_json_col
from .functions.math import exact_sum, safe_avg
from .functions.time import (format_ts, from_epoch_ms, parse_any_ts, parse_iso_ts, parse_sql_ts, to_epoch_ms,
                             to_ntz)
from .operators import aggregates as A
from .operators import decode as D
from .operators import filters as FL
from .operators import latest as LW
from .operators import timeseries as TS
from .operators import topn as TN
from .operators.anomalies import anomalies
from .plans import jobs as J
from .plans.sql import run_sql, tumbling_avg_sql
from .schemas import WINDOW_AVG_MESSAGE
from .session import ensure_utc, scratch_path
from .sources import bus as B
from .sources import fixtures as X
from .sources import tables as TB
from .sources.catalog import declare_sink, declare_stream, declare_topic
from .sources.replay import replay_files, replay_slices
from .streaming import sinks as S
from .streaming.runner import (cluster_cores, late_rows, progress_dicts, progress_metrics, start_query,
                               store_progress, stored_metrics)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run
    return deco


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, to_ntz(c))
    return df


# --------------------------------------------------------------------------
# Oracle-side definitions of the fixtures (same rules as sources.fixtures).
# --------------------------------------------------------------------------

_STATUS_SQL = "CASE event_type WHEN 'error' THEN 'FAIL' WHEN 'purchase' THEN 'WARN' ELSE 'OK' END"
_HUM_SQL = "TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)"
_CAD_TS_SQL = "make_timestamp((1704067200000 + event_id * 200) * 1000)"
_CAD_DEV_SQL = "'device-' || CAST(event_id % 10 + 1 AS VARCHAR)"

CADENCE_SQL = f"""
SELECT event_id, {_CAD_DEV_SQL} AS device_id, {_CAD_TS_SQL} AS ts,
       value AS temperature, {_HUM_SQL} AS humidity, {_STATUS_SQL} AS status
FROM events"""

NATURAL_SQL = f"""
SELECT event_id, 'device-' || CAST(user_id AS VARCHAR) AS device_id, ts,
       value AS temperature, {_HUM_SQL} AS humidity, {_STATUS_SQL} AS status
FROM events"""

# Data contract: readings carry at most two decimals (the producers round to
# two), so sums are exact as DECIMAL(28,2) on both sides of the oracle.
SCALE = 2

_SQLMS = "strftime({t}, '%Y-%m-%d %H:%M:%S.%g')"
_ISO = "strftime({t}, '%Y-%m-%dT%H:%M:%S.%f')"

# Reject rule of the corrupt message fixture (first match wins).
_REASON_SQL = """CASE WHEN event_id % 97 = 0 THEN 'malformed_json'
     WHEN event_id % 101 = 0 THEN 'missing_timestamp'
     WHEN event_id % 103 = 0 THEN 'bad_time'
     WHEN event_id % 107 = 0 THEN 'missing_temperature' END"""


def _bucket(ts: str, us: int, end: bool = False) -> str:
    s = f"make_timestamp(epoch_us({ts}) // {us} * {us})"
    return f"make_timestamp(epoch_us({ts}) // {us} * {us} + {us})" if end else s


def _exact_mean_sql(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({c})"


MIN_US = 60_000_000
FIVE_MIN_US = 300_000_000
DAY_US = 86_400_000_000


# --------------------------------------------------------------------------
# Tumbling average (the flagship)
# --------------------------------------------------------------------------

@register("tumbling_avg_1m", f"""
WITH r AS ({CADENCE_SQL})
SELECT device_id, {_bucket('ts', MIN_US)} AS window_start, {_bucket('ts', MIN_US, True)} AS window_end,
       {_exact_mean_sql('temperature')} AS avg_temp
FROM r GROUP BY 1, 2, 3""")
def q_tumbling_avg_1m(spark, sf_dir):
    """A1: mean temperature per device and 1-minute window (cadence readings)."""
    r = X.cadence_readings(X.events(spark, sf_dir))
    return _ntz(A.tumbling_avg(r, "device_id", "ts", "1 minute", exact_scale=SCALE), "window_start", "window_end")


@register("tumbling_mean_5m", f"""
WITH r AS ({CADENCE_SQL})
SELECT device_id, {_bucket('ts', FIVE_MIN_US)} AS window_start, {_bucket('ts', FIVE_MIN_US, True)} AS window_end,
       max(ts) AS last_event_ts,
       CAST(SUM(CAST(temperature AS DECIMAL(18,2))) AS DOUBLE) AS sum_temp,
       COUNT(temperature) AS n,
       CASE WHEN COUNT(temperature) > 0
            THEN CAST(SUM(CAST(temperature AS DECIMAL(18,2))) AS DOUBLE) / COUNT(temperature)
            ELSE 0.0 END AS avg_temp
FROM r GROUP BY 1, 2, 3""")
def q_tumbling_mean_5m(spark, sf_dir):
    """A2: (max time, sum, count) per device and 5-minute window, then mean."""
    r = X.cadence_readings(X.events(spark, sf_dir))
    out = A.tumbling_mean_parts(r, "device_id", "ts", "5 minutes", exact_scale=SCALE)
    return _ntz(out, "window_start", "window_end", "last_event_ts")


@register("tumbling_avg_1d_natural", f"""
WITH r AS ({NATURAL_SQL})
SELECT device_id, {_bucket('ts', DAY_US)} AS window_start, {_bucket('ts', DAY_US, True)} AS window_end,
       {_exact_mean_sql('temperature')} AS avg_temp, COUNT(*) AS n
FROM r GROUP BY 1, 2, 3""")
def q_tumbling_avg_1d_natural(spark, sf_dir):
    """A1 on the natural (sparse, irregular) readings with 1-day windows."""
    r = X.natural_readings(X.events(spark, sf_dir))
    out = A.tumbling_agg(r, "device_id", "ts", "1 day",
                         {"avg_temp": A.exact_mean("temperature", SCALE), "n": F.count(F.lit(1))})
    return _ntz(out, "window_start", "window_end")


# --------------------------------------------------------------------------
# Dashboard aggregates
# --------------------------------------------------------------------------

@register("count_rows", "SELECT COUNT(*) AS n FROM events")
def q_count_rows(spark, sf_dir):
    """A3: ``SELECT COUNT(*)`` over all readings."""
    return A.count_rows(X.natural_readings(X.events(spark, sf_dir)))


@register("count_by_device", f"""
WITH r AS ({NATURAL_SQL})
SELECT device_id, COUNT(*) AS record_count FROM r GROUP BY device_id""")
def q_count_by_device(spark, sf_dir):
    """A4: records per device."""
    return A.count_by(X.natural_readings(X.events(spark, sf_dir)), "device_id")


@register("status_distribution", f"""
WITH r AS ({NATURAL_SQL}), c AS (SELECT status, COUNT(*) AS n FROM r GROUP BY status)
SELECT status, n, n / SUM(n) OVER () AS share FROM c""")
def q_status_distribution(spark, sf_dir):
    """A5: readings per status and share of all readings."""
    return A.status_distribution(X.natural_readings(X.events(spark, sf_dir)))


@register("status_distribution_by_device", f"""
WITH r AS ({CADENCE_SQL}), c AS (SELECT device_id, status, COUNT(*) AS n FROM r GROUP BY 1, 2)
SELECT device_id, status, n, n / SUM(n) OVER (PARTITION BY device_id) AS share FROM c""")
def q_status_distribution_by_device(spark, sf_dir):
    """A5 with keys: status share within each device."""
    return A.status_distribution(X.cadence_readings(X.events(spark, sf_dir)), "device_id")


@register("trend_5m", f"""
WITH r AS ({CADENCE_SQL})
SELECT {_bucket('ts', FIVE_MIN_US)} AS window_start, {_bucket('ts', FIVE_MIN_US, True)} AS window_end,
       {_exact_mean_sql('temperature')} AS avg_temperature, MIN(temperature) AS min_temperature,
       MAX(temperature) AS max_temperature,
       {_exact_mean_sql('humidity')} AS avg_humidity, MIN(humidity) AS min_humidity,
       MAX(humidity) AS max_humidity, COUNT(*) AS n
FROM r GROUP BY 1, 2""")
def q_trend_5m(spark, sf_dir):
    """temperature/humidity trend over 5-minute buckets, all devices."""
    r = X.cadence_readings(X.events(spark, sf_dir))
    return _ntz(A.trend(r, "ts", "5 minutes", ["temperature", "humidity"], exact_scale=SCALE),
                "window_start", "window_end")


# --------------------------------------------------------------------------
# Decode and clean
# --------------------------------------------------------------------------

_MSG_FIELDS_SQL = f"""
SELECT CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS "offset",
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE {_CAD_DEV_SQL} END AS device_id,
  CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN NULL
       WHEN event_id % 103 = 0 THEN {_ISO.format(t=_CAD_TS_SQL)}
       ELSE {_SQLMS.format(t=_CAD_TS_SQL)} END AS "timestamp",
  CASE WHEN event_id % 97 = 0 OR (event_id % 107 = 0 AND event_id % 101 <> 0 AND event_id % 103 <> 0)
       THEN NULL ELSE value END AS temperature,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE {_HUM_SQL} END AS humidity,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE {_STATUS_SQL} END AS status,
  event_id % 97 = 0 AS malformed
FROM events"""


@register("decode_json", _MSG_FIELDS_SQL)
def q_decode_json(spark, sf_dir):
    """Bus messages (some broken) -> typed fields and a malformed flag."""
    env = X.messages(X.events(spark, sf_dir), corrupt=True)
    d = D.coerce(D.decode_json(env), {"temperature": "double", "humidity": "double"})
    return d.select("partition", "offset", "device_id", "timestamp", "temperature",
                    "humidity", "status", "malformed")


@register("valid_readings", f"""
WITH r AS ({CADENCE_SQL})
SELECT CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS "offset", device_id, ts, temperature, humidity, status
FROM r WHERE ({_REASON_SQL}) IS NULL""")
def q_valid_readings(spark, sf_dir):
    """Rows that survive decode, required-field, number and time checks."""
    env = X.messages(X.events(spark, sf_dir), corrupt=True)
    valid, _ = D.split_valid(D.decode_readings(env))
    return _ntz(valid.select("partition", "offset", *D.READING_FIELDS), "ts")


@register("rejected_readings", f"""
SELECT CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS "offset", {_REASON_SQL} AS reject_reason
FROM events WHERE ({_REASON_SQL}) IS NOT NULL""")
def q_rejected_readings(spark, sf_dir):
    """The rejected messages with the first failing check."""
    env = X.messages(X.events(spark, sf_dir), corrupt=True)
    _, rej = D.split_valid(D.decode_readings(env))
    return rej.select("partition", "offset", D.REASON)


@register("project_fields", f"""
WITH r AS ({CADENCE_SQL})
SELECT device_id AS device, ts AS event_time, temperature AS temp_c FROM r""")
def q_project_fields(spark, sf_dir):
    """Pick and rename fields (sink column mapping)."""
    r = X.cadence_readings(X.events(spark, sf_dir))
    out = D.project(r, {"device": "device_id", "event_time": "ts", "temp_c": "temperature"})
    return _ntz(out, "event_time")


@register("coerce_double", f"""
SELECT CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS "offset", value AS temperature,
       event_id % 109 = 0 AS was_text
FROM events
WHERE event_id % 97 <> 0 AND event_id % 101 <> 0 AND event_id % 103 <> 0 AND event_id % 107 <> 0""")
def q_coerce_double(spark, sf_dir):
    """Number fields read as text, then ``try_cast`` (quoted numbers pass)."""
    env = X.messages(X.events(spark, sf_dir), corrupt=True)
    valid, _ = D.split_valid(D.decode_readings(env))
    return valid.select("partition", "offset", "temperature",
                        F.col("raw").contains('"temperature":"').alias("was_text"))


@register("safe_mean", f"""
WITH r AS ({CADENCE_SQL}), w AS (
  SELECT device_id, {_bucket('ts', MIN_US)} AS window_start,
         CAST(SUM(CAST(CASE WHEN status = 'FAIL' THEN temperature END AS DECIMAL(18,2))) AS DOUBLE) AS fail_sum,
         COUNT(CASE WHEN status = 'FAIL' THEN temperature END) AS fail_n
  FROM r GROUP BY 1, 2)
SELECT device_id, window_start, fail_n,
       CASE WHEN fail_n > 0 THEN fail_sum / fail_n ELSE 0.0 END AS fail_avg
FROM w""")
def q_safe_mean(spark, sf_dir):
    """Zero-guarded mean; windows with no FAIL reading give 0.0, not an error."""
    r = X.cadence_readings(X.events(spark, sf_dir))
    fail_t = F.when(F.col("status") == "FAIL", F.col("temperature"))
    w = A.tumbling_agg(r, "device_id", "ts", "1 minute",
                       {"fail_sum": exact_sum(fail_t, SCALE), "fail_n": F.count(fail_t)})
    out = w.select("device_id", "window_start", "fail_n", safe_avg("fail_sum", "fail_n").alias("fail_avg"))
    return _ntz(out, "window_start")


@register("encode_json", f"""
WITH r AS ({CADENCE_SQL})
SELECT CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS "offset",
  '{{"device_id":"' || device_id || '","timestamp":"' || {_SQLMS.format(t='ts')} ||
  '","temperature":' || CAST(temperature AS VARCHAR) || ',"humidity":' || CAST(humidity AS VARCHAR) ||
  ',"status":"' || status || '"}}' AS message
FROM r""")
def q_encode_json(spark, sf_dir):
    """Readings -> JSON messages with SQL-form millisecond times."""
    r = X.cadence_readings(X.events(spark, sf_dir), with_event_id=True)
    r = r.withColumn("timestamp", F.col("ts"))
    return r.select((F.col("event_id") % 3).cast("int").alias("partition"),
                    F.floor(F.col("event_id") / 3).cast("long").alias("offset"),
                    to_json_col(["device_id", "timestamp", "temperature", "humidity", "status"])
                    .alias("message"))


# Ten forms of a time text by event_id; what each parse makes of them.
_TS_TEXT_SQL = f"""
SELECT event_id, event_id % 10 AS form, {_CAD_TS_SQL} AS t,
       make_timestamp((1704067200000 + event_id * 200) // 1000 * 1000000) AS s
FROM events"""


def _ts_texts(spark, sf_dir) -> DataFrame:
    """Time strings of every form a bus may carry, readable or not."""
    t, whole = X.cadence_ts(), "yyyy-MM-dd HH:mm:ss"
    forms = [format_ts(t, "sql_ms"), format_ts(t, "iso"), F.concat(format_ts(t, "iso"), F.lit("Z")),
             F.concat(format_ts(t, "iso"), F.lit("+02:00")), F.concat(format_ts(t, "sql_ms"), F.lit("123")),
             F.concat(format_ts(t, whole), F.lit(".5")), format_ts(t, "HH:mm:ss"), format_ts(t, "yyyy"),
             F.lit("no time"), F.lit(None).cast("string")]
    text = F.element_at(F.array(*forms), (F.col("event_id") % 10 + 1).cast("int"))
    return X.events(spark, sf_dir).select("event_id", text.alias("timestamp"))


_ISO_CASES = """CASE form WHEN 0 THEN t WHEN 1 THEN t WHEN 2 THEN t WHEN 3 THEN t - INTERVAL 2 HOUR
     WHEN 4 THEN t + INTERVAL 123 MICROSECOND WHEN 5 THEN s + INTERVAL 500 MILLISECOND END"""


@register("parse_sql_ts", f"""
WITH x AS ({_TS_TEXT_SQL})
SELECT event_id, CASE form WHEN 0 THEN t WHEN 5 THEN s + INTERVAL 500 MILLISECOND END AS ts FROM x""")
def q_parse_sql_ts(spark, sf_dir):
    """SQL form with at most three fraction digits; every other text is NULL."""
    return _ntz(_ts_texts(spark, sf_dir).select("event_id", parse_sql_ts("timestamp").alias("ts")), "ts")


@register("parse_iso_ts", f"WITH x AS ({_TS_TEXT_SQL}) SELECT event_id, {_ISO_CASES} AS ts FROM x")
def q_parse_iso_ts(spark, sf_dir):
    """ISO-8601 parse (zones, ``T`` or blank); shorter texts are NULL."""
    return _ntz(_ts_texts(spark, sf_dir).select("event_id", parse_iso_ts("timestamp").alias("ts")), "ts")


@register("parse_any_ts", f"WITH x AS ({_TS_TEXT_SQL}) SELECT event_id, {_ISO_CASES} AS ts FROM x")
def q_parse_any_ts(spark, sf_dir):
    """SQL form (1-6 fraction digits) first, then ISO."""
    return _ntz(_ts_texts(spark, sf_dir).select("event_id", parse_any_ts("timestamp").alias("ts")), "ts")


@register("epoch_ms", """
SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts_back
FROM events""")
def q_epoch_ms(spark, sf_dir):
    """T4: time <-> epoch milliseconds (microseconds are cut)."""
    ev = X.events(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    out = ev.select("event_id", to_epoch_ms("ts").alias("ts_ms"))
    return _ntz(out.withColumn("ts_back", from_epoch_ms("ts_ms")), "ts_back")


@register("format_ts", f"""
SELECT event_id, {_SQLMS.format(t='ts')} AS sql_ms, {_ISO.format(t='ts')} AS iso FROM events""")
def q_format_ts(spark, sf_dir):
    """T5: time -> text, SQL form truncated to ms, and ISO with microseconds."""
    ev = X.events(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return ev.select("event_id", format_ts("ts", "sql_ms").alias("sql_ms"), format_ts("ts", "iso").alias("iso"))


@register("null_time_quarantine", f"""
SELECT CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS "offset",
       CASE WHEN event_id % 97 = 0 THEN 'malformed_json' ELSE 'null_time' END AS reject_reason
FROM events WHERE event_id % 97 = 0 OR event_id % 101 = 0 OR event_id % 103 = 0""")
def q_null_time_quarantine(spark, sf_dir):
    """With time not required, rows whose event time is NULL (absent or
    unparseable) are quarantined instead of failing the job."""
    env = X.messages(X.events(spark, sf_dir), corrupt=True)
    d = D.decode_json(env)
    d = D.flag_malformed(d)
    d = D.with_event_time(d, "timestamp", "ts", "sql", flag=False)
    d = D.require_event_time(d, "ts", "quarantine")
    _, rej = D.split_valid(d)
    return rej.select("partition", "offset", D.REASON)


# --------------------------------------------------------------------------
# Filters and routing
# --------------------------------------------------------------------------


_TOPIC_SQL = """CASE WHEN event_id % 5 = 0 THEN 'temperature_averages'
     WHEN event_id % 13 = 0 THEN 'unknown_topic' ELSE 'iot_sensor_data' END"""


@register("route_topics", f"""
SELECT CASE {_TOPIC_SQL} WHEN 'iot_sensor_data' THEN 'readings'
            WHEN 'temperature_averages' THEN 'averages' ELSE 'rejected' END AS route,
       COUNT(*) AS n
FROM events GROUP BY 1""")
def q_route_topics(spark, sf_dir):
    """Records per handler when one reader serves two topics (+ unknown)."""
    env = X.messages(X.events(spark, sf_dir), two_topics=True)
    tagged = FL.route(env, {"iot_sensor_data": "readings", "temperature_averages": "averages"})
    return tagged.groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@register("start_from_ts", f"""
SELECT 'iot_sensor_data' AS topic, CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS "offset", {_CAD_TS_SQL} AS "timestamp"
FROM events
WHERE ({_TOPIC_SQL}) = 'iot_sensor_data' AND {_CAD_TS_SQL} >= TIMESTAMP '2024-01-01 00:10:00'""")
def q_start_from_ts(spark, sf_dir):
    """Read one topic of a multi-topic bus from a start time on."""
    env = X.messages(X.events(spark, sf_dir), two_topics=True)
    out = B.select_envelope(env, ["iot_sensor_data"], start="2024-01-01T00:10:00")
    return _ntz(out.select("topic", "partition", "offset", "timestamp"), "timestamp")


@register("time_range", f"""
WITH r AS ({NATURAL_SQL})
SELECT device_id, ts, temperature FROM r
WHERE ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-05 00:00:00'""")
def q_time_range(spark, sf_dir):
    """readings inside a dashboard time range (pushed to the scan)."""
    r = X.natural_readings(X.events(spark, sf_dir))
    out = FL.time_range(r, "ts", "2024-01-03 00:00:00", "2024-01-05 00:00:00")
    return _ntz(out.select("device_id", "ts", "temperature"), "ts")


_METRIC_BASE_SQL = f"""
SELECT 'device-' || CAST(event_id % 10 + 1 AS VARCHAR) AS pod,
       CASE WHEN event_id % 10 + 1 <= 8 THEN 'iot-pipeline' ELSE 'default' END AS namespace,
       CASE (event_id % 10 + 1) % 3 WHEN 1 THEN 'sensor' WHEN 2 THEN 'POD' ELSE '' END AS container,
       {_CAD_TS_SQL} AS ts, event_id, value AS gauge, CAST((event_id // 10) % 50 AS DOUBLE) AS counter
FROM events"""

_LABELS = ["namespace", "pod", "container"]


def _metric(spark, sf_dir, name: str) -> DataFrame:
    m = X.metrics(X.events(spark, sf_dir)).filter(F.col("metric") == name)
    return FL.with_labels(m, _LABELS)


@register("match_labels", f"""
WITH m AS ({_METRIC_BASE_SQL})
SELECT pod, container, ts, gauge AS value FROM m
WHERE namespace = 'iot-pipeline' AND container <> 'POD' AND container <> ''""")
def q_match_labels(spark, sf_dir):
    """``sensor_temperature{namespace="iot-pipeline", container!="POD", container!=""}``."""
    m = X.metrics(X.events(spark, sf_dir)).filter(F.col("metric") == X.GAUGE_METRIC)
    sel = FL.match_labels(m, eq={"namespace": "iot-pipeline"}, ne={"container": "POD"})
    sel = FL.match_labels(sel, ne={"container": ""})
    return _ntz(sel.select(FL.label("pod").alias("pod"), FL.label("container").alias("container"),
                           "ts", "value"), "ts")


# --------------------------------------------------------------------------
# Metric series
# --------------------------------------------------------------------------


_STEP_SQL = "make_timestamp(((epoch_us(ts) // 1000 - 1) // 60000 + 1) * 60000 * 1000)"


@register("counter_rate_5m", f"""
WITH m AS ({_METRIC_BASE_SQL}),
i AS (SELECT namespace, pod, container, ts, counter AS value,
             lag(counter) OVER (PARTITION BY namespace, pod, container ORDER BY ts, counter) AS p FROM m),
j AS (SELECT *, CASE WHEN p IS NULL THEN 0.0 WHEN value >= p THEN value - p ELSE value END AS inc,
             epoch_us(ts) // 1000 AS ms FROM i)
SELECT namespace, pod, container, ts, value,
       (SUM(inc) OVER w - FIRST_VALUE(inc) OVER w) / 300.0 AS rate
FROM j
WINDOW w AS (PARTITION BY namespace, pod, container ORDER BY ms RANGE BETWEEN 299999 PRECEDING AND CURRENT ROW)""")
def q_counter_rate_5m(spark, sf_dir):
    """``rate(sensor_readings_total[5m])`` at every sample of every series."""
    c = _metric(spark, sf_dir, X.COUNTER_METRIC)
    r = TS.counter_rate(c, _LABELS, "ts", "value", "5 minutes", bucket="10 minutes")
    return _ntz(r.select(*_LABELS, "ts", "value", "rate"), "ts")


@register("gauge_at", f"""
WITH m AS ({_METRIC_BASE_SQL}),
f AS (SELECT * FROM m WHERE ts <= TIMESTAMP '2024-01-01 00:20:00' AND ts > TIMESTAMP '2024-01-01 00:15:00'),
r AS (SELECT *, row_number() OVER (PARTITION BY namespace, pod, container ORDER BY ts DESC, gauge DESC) AS rn FROM f)
SELECT namespace, pod, container, ts, gauge AS value FROM r WHERE rn = 1""")
def q_gauge_at(spark, sf_dir):
    """Instant value of every gauge series at 00:20 (5-minute look-back)."""
    g = _metric(spark, sf_dir, X.GAUGE_METRIC)
    return _ntz(TS.gauge_at(g, _LABELS, "2024-01-01 00:20:00", "ts", "value", "5 minutes"), "ts")


@register("sum_by_label", f"""
WITH m AS ({_METRIC_BASE_SQL}),
s AS (SELECT *, {_STEP_SQL} AS step_ts FROM m WHERE namespace = 'iot-pipeline'),
r AS (SELECT *, row_number() OVER (PARTITION BY namespace, pod, container, step_ts
                                    ORDER BY ts DESC, gauge DESC) AS rn FROM s)
SELECT container, step_ts, CAST(SUM(CAST(gauge AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM r WHERE rn = 1 GROUP BY container, step_ts""")
def q_sum_by_label(spark, sf_dir):
    """``sum(sensor_temperature{namespace="iot-pipeline"}) by (container)``
    at every 1-minute step."""
    g = FL.match_labels(_metric(spark, sf_dir, X.GAUGE_METRIC), eq={"namespace": "iot-pipeline"})
    out = TS.sum_by(g, "container", _LABELS, "1 minute", exact_scale=SCALE)
    return _ntz(out, "step_ts")


@register("sum_rate_by_label", f"""
WITH m AS ({_METRIC_BASE_SQL}),
i AS (SELECT namespace, pod, container, ts, counter AS value,
             lag(counter) OVER (PARTITION BY namespace, pod, container ORDER BY ts, counter) AS p FROM m),
j AS (SELECT *, CASE WHEN p IS NULL THEN 0.0 WHEN value >= p THEN value - p ELSE value END AS inc,
             epoch_us(ts) // 1000 AS ms FROM i),
k AS (SELECT *, (SUM(inc) OVER w - FIRST_VALUE(inc) OVER w) / 300.0 AS rate FROM j
      WINDOW w AS (PARTITION BY namespace, pod, container ORDER BY ms
                   RANGE BETWEEN 299999 PRECEDING AND CURRENT ROW)),
s AS (SELECT *, {_STEP_SQL} AS step_ts FROM k),
r AS (SELECT *, row_number() OVER (PARTITION BY namespace, pod, container, step_ts
                                    ORDER BY ts DESC, rate DESC) AS rn FROM s)
SELECT pod, step_ts, SUM(rate) AS rate FROM r WHERE rn = 1 GROUP BY pod, step_ts""")
def q_sum_rate_by_label(spark, sf_dir):
    """``sum(rate(sensor_readings_total[5m])) by (pod)`` per 1-minute step."""
    c = _metric(spark, sf_dir, X.COUNTER_METRIC)
    r = TS.counter_rate(c, _LABELS, "ts", "value", "5 minutes", bucket="10 minutes")
    return _ntz(TS.sum_by(r, "pod", _LABELS, "1 minute", value="rate", out="rate"), "step_ts")


# --------------------------------------------------------------------------
# L1, L2: newest-n and head
# --------------------------------------------------------------------------

@register("latest_n", f"""
WITH r AS ({NATURAL_SQL}),
k AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ts DESC) AS rn FROM r)
SELECT device_id, ts, temperature, status FROM k WHERE rn <= 3""")
def q_latest_n(spark, sf_dir):
    """L1 (all keys): newest 3 readings of every device."""
    r = X.natural_readings(X.events(spark, sf_dir))
    cols = r.select("device_id", "ts", "temperature", "status")   # project first: ties break on these only
    return _ntz(TN.latest_n(cols, "device_id", "ts", 3), "ts")


@register("latest_n_device", f"""
WITH r AS ({CADENCE_SQL})
SELECT device_id, ts, temperature, humidity, status FROM r WHERE device_id = 'device-1'
ORDER BY ts DESC LIMIT 100""")
def q_latest_n_device(spark, sf_dir):
    """L1 (one key): ``WHERE device_id = 'device-1' ORDER BY ts DESC LIMIT 100``."""
    r = FL.key_equals(X.cadence_readings(X.events(spark, sf_dir)), "device_id", "device-1")
    return _ntz(TN.latest_n(r, None, "ts", 100), "ts")


@register("head_n", f"""
SELECT 'iot_sensor_data' AS topic, CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS "offset" FROM events
WHERE ({_TOPIC_SQL}) = 'iot_sensor_data'
ORDER BY partition, "offset" LIMIT 10""")
def q_head_n(spark, sf_dir):
    """L2: first 10 messages of a topic (in bus order)."""
    env = B.select_envelope(X.messages(X.events(spark, sf_dir), two_topics=True), "iot_sensor_data")
    return TN.head(env.select("topic", "partition", "offset"), 10, ["partition", "offset"])


# --------------------------------------------------------------------------
# Keyed tables and quarantine
# --------------------------------------------------------------------------


_COLLIDING_LATEST_SQL = f"""
WITH r AS ({CADENCE_SQL}),
c AS (SELECT event_id, device_id, date_trunc('minute', ts) AS ts, temperature, humidity, status FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY device_id, ts ORDER BY event_id DESC) AS rn FROM c)
SELECT event_id, device_id, ts, temperature, humidity, status FROM k WHERE rn = 1"""


@register("upsert_latest", _COLLIDING_LATEST_SQL)
def q_upsert_latest(spark, sf_dir):
    """K2 (operator): last write wins per (device, minute); order = event_id."""
    c = X.colliding_readings(X.events(spark, sf_dir))
    return _ntz(LW.latest_wins(c, ["device_id", "ts"], "event_id"), "ts")


def _write_colliding_table(spark, sf_dir, batches: int = 3) -> str:
    """The colliding fixture written as ``batches`` log batches (by event_id
    range, so later writes carry later versions)."""
    c = X.colliding_readings(X.events(spark, sf_dir))
    path = scratch_path(spark, "table", "colliding")
    m = TB.create_table_if_absent(spark, path, c.schema, ["device_id", "ts"], ["event_id"])
    bounds = c.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    width = (hi - lo) // batches + 1
    for i in range(batches):
        part = c.filter((F.col("event_id") >= lo + i * width) & (F.col("event_id") < lo + (i + 1) * width))
        m = TB.upsert_table(part, path, i, manifest=m)
    return path


@register("read_latest_table", _COLLIDING_LATEST_SQL)
def q_read_latest_table(spark, sf_dir):
    """Write the fixture as a keyed table (3 batches), read the latest view."""
    path = _write_colliding_table(spark, sf_dir)
    return _ntz(TB.read_table(spark, path), "ts")


@register("device_filter", f"""
WITH t AS ({_COLLIDING_LATEST_SQL}) SELECT * FROM t WHERE device_id = 'device-3'""")
def q_device_filter(spark, sf_dir):
    """``WHERE device_id = 'device-3'`` on a keyed table (pushed below the
    latest-wins aggregate into the scan)."""
    path = _write_colliding_table(spark, sf_dir)
    return _ntz(FL.key_equals(TB.read_table(spark, path), "device_id", "device-3"), "ts")


def _json_sql(with_ts: str | None, temp: str | None) -> str:
    parts = [f"""'{{"device_id":"' || {_CAD_DEV_SQL} || '"'"""]
    if with_ts is not None:
        parts.append(f"""',"timestamp":"' || {with_ts} || '"'""")
    if temp is not None:
        parts.append(f"""',"temperature":' || {temp}""")
    parts.append(f"""',"humidity":' || CAST({_HUM_SQL} AS VARCHAR)""")
    parts.append(f"""',"status":"' || {_STATUS_SQL} || '"}}'""")
    return " || ".join(parts)


_RAW_SQL = f"""CASE WHEN event_id % 97 = 0 THEN 'not json'
  WHEN event_id % 101 = 0 THEN {_json_sql(None, 'CAST(value AS VARCHAR)')}
  WHEN event_id % 103 = 0 THEN {_json_sql(_ISO.format(t=_CAD_TS_SQL), 'CAST(value AS VARCHAR)')}
  WHEN event_id % 107 = 0 THEN {_json_sql(_SQLMS.format(t=_CAD_TS_SQL), None)} END"""


@register("quarantine_rows", f"""
SELECT 'iot_sensor_data' AS topic, CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS "offset",
       {_REASON_SQL} AS reject_reason, {_RAW_SQL} AS raw
FROM events WHERE ({_REASON_SQL}) IS NOT NULL""")
def q_quarantine_rows(spark, sf_dir):
    """K6: rejected messages with position, reason and the raw text."""
    env = X.messages(X.events(spark, sf_dir), corrupt=True)
    _, rej = D.split_valid(D.decode_readings(env))
    return rej.select("topic", "partition", "offset", D.REASON, "raw")


# --------------------------------------------------------------------------
# Q1, X1
# --------------------------------------------------------------------------



@register("sql_tumbling_avg", ORACLE["tumbling_avg_1m"])
def q_sql_tumbling_avg(spark, sf_dir):
    """Q1: the tumbling average as SQL text over a declared source."""
    r = X.cadence_readings(X.events(spark, sf_dir))
    declare_stream(spark, "iot_sensor_data_q1", r, "ts", watermark="5 seconds")
    out = run_sql(spark, tumbling_avg_sql("iot_sensor_data_q1", "ts", "1 minute", exact_scale=2))
    return _ntz(out, "window_start", "window_end")


@register("anomalies", f"""
WITH r AS ({CADENCE_SQL}),
w AS (SELECT device_id, {_bucket('ts', MIN_US)} AS window_start, {_bucket('ts', MIN_US, True)} AS window_end,
             {_exact_mean_sql('temperature')} AS avg_temp FROM r GROUP BY 1, 2, 3),
a AS (SELECT *, COUNT(avg_temp) OVER x AS prev_n, AVG(avg_temp) OVER x AS prev_mean,
             STDDEV_SAMP(avg_temp) OVER x AS prev_std
      FROM w WINDOW x AS (PARTITION BY device_id ORDER BY window_start ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))
SELECT device_id, window_start, window_end, avg_temp, prev_n, ROUND(prev_mean, 6) AS prev_mean, ROUND(prev_std, 6) AS prev_std,
       COALESCE(CASE WHEN prev_n < 3 THEN FALSE WHEN prev_std = 0 THEN avg_temp <> prev_mean
                     ELSE ABS(avg_temp - prev_mean) > 3.0 * prev_std END, FALSE) AS is_anomaly
FROM a""")
def q_anomalies(spark, sf_dir):
    """Windows whose mean leaves mean +- 3 sd of the previous 12 windows."""
    r = X.cadence_readings(X.events(spark, sf_dir))
    w = A.tumbling_avg(r, "device_id", "ts", "1 minute", exact_scale=SCALE)
    return _ntz(anomalies(w, "device_id", "window_start", "avg_temp", 12, 3.0), "window_start", "window_end")


@register("anomalies_split", ORACLE["anomalies"])
def q_anomalies_split(spark, sf_dir):
    """X1 with each device's history split into buckets of ten minutes (fewer rows than its 12 windows)."""
    r = X.cadence_readings(X.events(spark, sf_dir))
    w = A.tumbling_avg(r, "device_id", "ts", "1 minute", exact_scale=SCALE)
    out = anomalies(w, "device_id", "window_start", "avg_temp", 12, 3.0, bucket="10 minutes")
    return _ntz(out, "window_start", "window_end")


# --------------------------------------------------------------------------
# Streams (S1, S4, S5, W1-W7, K1-K5): incremental availableNow runs over a
# replayed bus, three time slices, state carried by the checkpoint.
# --------------------------------------------------------------------------



def _await(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _bus_records(spark, sf_dir, **options) -> DataFrame:
    """The readings as bus records, dealt to all cores for the replay."""
    return X.messages(X.dealt(X.events(spark, sf_dir), cluster_cores(spark)), **options)


def _replay_run(spark, env: DataFrame, name: str, build, slices: int = 3,
                progress: list | None = None) -> str:
    """Write ``env`` as ``slices`` time-ordered file drops; after each drop run
    ``build(stream, base, checkpoint)`` to completion.  Returns the base path;
    the runs' progress reports are appended to ``progress`` if given."""
    base = scratch_path(spark, "stream", name)
    src, ck = f"{base}/bus", f"{base}/checkpoint"

    def step(_i):
        stream = B.read_bus(spark, None, "parquet", src, streaming=True)
        q = build(stream, base, ck)
        _await(q)
        if progress is not None:
            progress.extend(progress_dicts(q))

    replay_slices(env, src, slices, after_each=step)
    return base


@register("stream_tumbling_avg_1m", ORACLE["tumbling_avg_1m"])
def q_stream_tumbling_avg_1m(spark, sf_dir):
    """Bus -> decode -> watermark 5 s -> 1-minute average -> keyed
    table (update mode), run incrementally; the table equals the batch result."""
    env = _bus_records(spark, sf_dir)
    base = _replay_run(spark, env, "avg1m",
                       lambda s, b, ck: J.windowed_averages(s, f"{b}/avg", ck, "1 minute", "5 seconds",
                                                            state_partitions=cluster_cores(spark),
                                                            exact_scale=SCALE))
    out = TB.read_table(spark, f"{base}/avg")
    return _ntz(out.select("device_id", "window_start", "window_end", "avg_temp"), "window_start", "window_end")


@register("stream_mean_5m", ORACLE["tumbling_mean_5m"])
def q_stream_mean_5m(spark, sf_dir):
    """In-order variant (watermark 0 s), 5-minute (max ts, sum, count)."""
    env = _bus_records(spark, sf_dir)
    base = _replay_run(spark, env, "mean5m",
                       lambda s, b, ck: J.windowed_averages(s, f"{b}/avg", ck, "5 minutes", "0 seconds",
                                                            parts=True, state_partitions=cluster_cores(spark),
                                                            exact_scale=SCALE))
    out = TB.read_table(spark, f"{base}/avg")
    return _ntz(out.select("device_id", "window_start", "window_end", "last_event_ts", "sum_temp", "n",
                           "avg_temp"), "window_start", "window_end", "last_event_ts")


@register("stream_raw_table", f"""
WITH r AS ({CADENCE_SQL})
SELECT device_id, ts, temperature, humidity, status, event_id // 3 AS bus_offset
FROM r WHERE ({_REASON_SQL}) IS NULL""")
def q_stream_raw_table(spark, sf_dir):
    """Decoded readings stored in a keyed raw table by a stream."""
    env = _bus_records(spark, sf_dir, corrupt=True)
    base = _replay_run(spark, env, "raw",
                       lambda s, b, ck: J.readings_to_tables(s, f"{b}/raw", f"{b}/rejects", ck))
    raw = TB.read_table(spark, f"{base}/raw")
    return _ntz(raw.select("device_id", "ts", "temperature", "humidity", "status", "bus_offset"), "ts")


@register("stream_quarantine", ORACLE["quarantine_rows"])
def q_stream_quarantine(spark, sf_dir):
    """K6: the same stream's rejects, written per micro-batch."""
    env = _bus_records(spark, sf_dir, corrupt=True)
    base = _replay_run(spark, env, "rejects",
                       lambda s, b, ck: J.readings_to_tables(s, f"{b}/raw", f"{b}/rejects", ck))
    rej = spark.read.parquet(f"{base}/rejects")
    return rej.select("topic", "partition", "offset", D.REASON, "raw")


@register("stream_route", f"""
WITH a AS (
  SELECT {_CAD_DEV_SQL} AS device_id, date_trunc('minute', {_CAD_TS_SQL}) AS window_start,
         date_trunc('minute', {_CAD_TS_SQL}) + INTERVAL 1 MINUTE AS window_end,
         value AS avg_temperature, event_id // 3 AS bus_offset, event_id
  FROM events WHERE event_id % 5 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY device_id, window_start ORDER BY event_id DESC) AS rn FROM a)
SELECT device_id, window_start, window_end, avg_temperature, bus_offset FROM k WHERE rn = 1""")
def q_stream_route(spark, sf_dir):
    """One stream over two topics, routed per micro-batch; this is
    the averages table it keeps (last write wins per device and window)."""
    env = _bus_records(spark, sf_dir, two_topics=True)
    base = _replay_run(spark, env, "route",
                       lambda s, b, ck: J.route_topics_to_tables(s, f"{b}/raw", f"{b}/avg", f"{b}/rejects", ck))
    avg = TB.read_table(spark, f"{base}/avg")
    return _ntz(avg.select("device_id", "window_start", "window_end", "avg_temperature", "bus_offset"),
                "window_start", "window_end")


@register("stream_route_counts", f"""
SELECT CASE {_TOPIC_SQL} WHEN 'iot_sensor_data' THEN 'raw' WHEN 'temperature_averages' THEN 'averages_messages'
            ELSE 'rejects' END AS target, COUNT(*) AS n
FROM events GROUP BY 1""")
def q_stream_route_counts(spark, sf_dir):
    """Rows stored per route by the routed stream (raw readings, all
    average messages incl. superseded versions, rejected unknown topics)."""
    env = _bus_records(spark, sf_dir, two_topics=True)
    base = _replay_run(spark, env, "route_counts",
                       lambda s, b, ck: J.route_topics_to_tables(s, f"{b}/raw", f"{b}/avg", f"{b}/rejects", ck))
    raw = TB.read_table(spark, f"{base}/raw").agg(F.count(F.lit(1)).alias("n")).withColumn("target", F.lit("raw"))
    avg = TB.table_versions(spark, f"{base}/avg").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("target", F.lit("averages_messages"))
    rej = spark.read.parquet(f"{base}/rejects").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("target", F.lit("rejects"))
    return raw.unionByName(avg).unionByName(rej).select("target", "n")


@register("stream_averages_bus", f"""
WITH r AS ({CADENCE_SQL}),
w AS (SELECT device_id, {_bucket('ts', MIN_US)} AS window_start, {_bucket('ts', MIN_US, True)} AS window_end,
             {_exact_mean_sql('temperature')} AS avg_temp FROM r GROUP BY 1, 2, 3)
SELECT 'iot_windowed_data' AS topic, device_id, window_start, window_end, avg_temp FROM w
WHERE window_end <= (SELECT max(ts) FROM r) - INTERVAL 5 SECOND""")
def q_stream_averages_bus(spark, sf_dir):
    """Windows appended once, when final, as JSON messages to a topic;
    read back from the topic and decoded.  Windows not yet closed by the
    watermark (end > max event time - 5 s) are still in state, by design."""
    env = _bus_records(spark, sf_dir)
    base = _replay_run(spark, env, "bus",
                       lambda s, b, ck: J.averages_to_bus(s, f"{b}/topic", ck,
                                                          state_partitions=cluster_cores(spark),
                                                          exact_scale=SCALE))
    return _windows_on_bus(spark, f"{base}/topic")


def _windows_on_bus(spark, path: str) -> DataFrame:
    topic = B.read_bus(spark, "iot_windowed_data", "parquet", path, streaming=False)
    m = from_json_col(F.col("value").cast("string"), WINDOW_AVG_MESSAGE)
    out = topic.select("topic", m.alias("m")).select(
        "topic", "m.device_id", parse_sql_ts("m.window_start").alias("window_start"),
        parse_sql_ts("m.window_end").alias("window_end"), "m.avg_temp")
    return _ntz(out, "window_start", "window_end")


@register("stream_sql_tumbling_avg", ORACLE["tumbling_avg_1m"])
def q_stream_sql_tumbling_avg(spark, sf_dir):
    """S5/Q1 on a stream: the decoded bus declared as a view with event time
    and a 5 s watermark, the average written as SQL text, run incrementally."""

    def build(stream, b, ck):
        valid, _ = D.split_valid(J.decoded(stream))
        declare_stream(spark, "iot_sensor_data_stream", valid, "ts", watermark="5 seconds")
        agg = run_sql(spark, tumbling_avg_sql("iot_sensor_data_stream", "ts", "1 minute", exact_scale=2))
        return start_query(agg, S.upsert_sink(f"{b}/avg", J.AVG_KEYS), "sql_avg", ck, "update",
                           no_data_batches=False, state_partitions=cluster_cores(spark))

    env = _bus_records(spark, sf_dir)
    base = _replay_run(spark, env, "sqlavg", build)
    return _ntz(TB.read_table(spark, f"{base}/avg"), "window_start", "window_end")


@register("describe_table", """
SELECT * FROM (VALUES (0, 'event_id', 'bigint', 'order'), (1, 'device_id', 'string', 'key'), (2, 'ts', 'timestamp', 'key'),
  (3, 'temperature', 'double', 'regular'), (4, 'humidity', 'double', 'regular'), (5, 'status', 'string', 'regular'))
  AS t(position, column_name, type, role)
WHERE (SELECT count(*) FROM events) > 0""")
def q_describe_table(spark, sf_dir):
    """``DESCRIBE`` of the keyed table that the fixture is stored in."""
    return TB.describe_table(spark, _write_colliding_table(spark, sf_dir))


@register("compacted_table", _COLLIDING_LATEST_SQL)
def q_compacted_table(spark, sf_dir):
    """K7: a keyed table compacted after two of its three batches (snapshot +
    live log) reads the same as the uncompacted latest view."""
    c = X.colliding_readings(X.events(spark, sf_dir))
    path = scratch_path(spark, "table", "compacted")
    m = TB.create_table_if_absent(spark, path, c.schema, ["device_id", "ts"], ["event_id"])
    b = c.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    lo, width = int(b["lo"]), (int(b["hi"]) - int(b["lo"])) // 3 + 1
    for i in range(3):
        m = TB.upsert_table(c.filter((F.col("event_id") >= lo + i * width)
                                     & (F.col("event_id") < lo + (i + 1) * width)), path, i, manifest=m)
        if i == 1:
            m = TB.compact(spark, path)
    return _ntz(TB.read_table(spark, path), "ts")


@register("stream_decode_metrics", f"""
SELECT 'observed_decode_counts_rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM events
UNION ALL
SELECT 'observed_decode_counts_rejected' AS metric,
       CAST(SUM(CASE WHEN ({_REASON_SQL}) IS NOT NULL THEN 1 ELSE 0 END) AS DOUBLE) AS value FROM events""")
def q_stream_decode_metrics(spark, sf_dir):
    """K8: per-batch success/error counts observed inside the decode stream,
    turned into METRIC rows from the query progress and summed per metric."""
    progress: list = []
    env = _bus_records(spark, sf_dir, corrupt=True)
    _replay_run(spark, env, "metrics",
                lambda s, b, ck: J.readings_to_tables(s, f"{b}/raw", f"{b}/rejects", ck), progress=progress)
    m = progress_metrics(spark, "readings_to_tables", progress)
    return (m.filter(F.col("metric").startswith("observed_"))
             .groupBy("metric").agg(F.sum("value").alias("value")))


@register("stream_route_rejects", f"""
WITH e AS (
  SELECT ({_TOPIC_SQL}) AS topic, CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS "offset", event_id
  FROM events),
r AS (
  SELECT topic, partition, "offset",
         CASE WHEN topic = 'unknown_topic' THEN 'unknown_topic'
              WHEN topic = 'iot_sensor_data' THEN
                CASE WHEN event_id % 97 = 0 THEN 'malformed_json'
                     WHEN event_id % 101 = 0 THEN 'missing_timestamp'
                     WHEN event_id % 103 = 0 THEN NULL
                     WHEN event_id % 107 = 0 THEN 'missing_temperature' END
         END AS reject_reason
  FROM e)
SELECT * FROM r WHERE reject_reason IS NOT NULL""")
def q_stream_route_rejects(spark, sf_dir):
    """The routed consumer over two topics with broken readings: unknown
    topics and bad readings land in one quarantine (ISO times are accepted by
    this consumer's SQL-then-ISO time parse)."""
    env = _bus_records(spark, sf_dir, corrupt=True, two_topics=True)
    base = _replay_run(spark, env, "route_rejects",
                       lambda s, b, ck: J.route_topics_to_tables(s, f"{b}/raw", f"{b}/avg", f"{b}/rejects", ck))
    return spark.read.parquet(f"{base}/rejects").select("topic", "partition", "offset", D.REASON)


@register("stream_windowed_rejects", ORACLE["quarantine_rows"])
def q_stream_windowed_rejects(spark, sf_dir):
    """K6: what a windowed job rejects is stored, not dropped."""
    env = _bus_records(spark, sf_dir, corrupt=True)
    base = _replay_run(spark, env, "window_rejects",
                       lambda s, b, ck: J.windowed_averages(s, f"{b}/avg", ck, rejects_path=f"{b}/rejects",
                                                            state_partitions=cluster_cores(spark)))
    return spark.read.parquet(f"{base}/rejects").select("topic", "partition", "offset", D.REASON, "raw")


#: Micro-batches of the late feed, and how long every 37th message is held up.
LATE_SLICES, LATE_BY = 24, "15 MINUTES"
_LATE_MS = 15 * 60_000
#: A micro-batch of the late feed has more than one file from twice so many rows on.
LATE_FILE_ROWS = 10_000

_LATE_SQL = f"""
WITH e AS (
  SELECT {_CAD_DEV_SQL} AS device_id, epoch_ms({_CAD_TS_SQL}) AS ts,
         epoch_ms({_CAD_TS_SQL}) + CASE WHEN event_id % 37 = 0 THEN {_LATE_MS} ELSE 0 END AS arrived
  FROM events),
b AS (SELECT min(arrived) AS lo, (max(arrived) - min(arrived)) // {LATE_SLICES} + 1 AS width FROM e),
s AS (SELECT e.*, dense_rank() OVER (ORDER BY (arrived - lo) // width) AS batch FROM e, b),
m AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch) AS seen FROM s GROUP BY batch),
-- a batch is held against the watermark of the batch before it: what was seen up to two batches ago, less 5 s
d AS (SELECT DISTINCT s.batch, device_id, s.ts // 60000 AS w, (s.ts // 60000 + 1) * 60000 <= m.seen - 5000 AS late
      FROM s LEFT JOIN m ON m.batch = s.batch - 2)"""


@register("stream_windowed_raw", ORACLE["stream_raw_table"])
def q_stream_windowed_raw(spark, sf_dir):
    """K5: the raw readings that a windowed job keeps, from the one reading of
    the bus that also gives its windows and its rejects."""
    env = _bus_records(spark, sf_dir, corrupt=True)
    base = _replay_run(spark, env, "window_raw",
                       lambda s, b, ck: J.windowed_averages(s, f"{b}/avg", ck, rejects_path=f"{b}/rejects", raw_path=f"{b}/raw",
                                                            state_partitions=cluster_cores(spark)))
    raw = TB.read_table(spark, f"{base}/raw")
    return _ntz(raw.select("device_id", "ts", "temperature", "humidity", "status", "bus_offset"), "ts")


@register("stream_late_rows", f"""{_LATE_SQL}
SELECT 'micro_batches' AS metric, CAST(max(batch) AS BIGINT) AS value FROM s
UNION ALL SELECT 'input_rows', count(*) FROM s
UNION ALL SELECT 'late_rows', count(*) FILTER (WHERE late) FROM d""")
def q_stream_late_rows(spark, sf_dir):
    """Late rows of a stream of 24 micro-batches, stopped half-way and
    started again, from the metrics it stored.  Spark counts late rows after
    partial aggregation: one for each device and window of a micro-batch."""
    env = X.messages(X.events(spark, sf_dir))
    late = (F.floor(F.unix_millis("timestamp") / 200) - F.lit(1704067200000 // 200)) % 37 == 0
    env = env.withColumn("timestamp", F.when(late, F.col("timestamp") + F.expr(f"INTERVAL {LATE_BY}"))
                         .otherwise(F.col("timestamp")))
    ms = F.unix_millis("timestamp")
    lo, hi, n = env.agg(F.min(ms), F.max(ms), F.count(F.lit(1))).first()
    files = max(1, min(cluster_cores(spark), n // (LATE_SLICES * LATE_FILE_ROWS)))
    env = env.withColumn("slice", F.floor((ms - F.lit(lo)) / F.lit((hi - lo) // LATE_SLICES + 1)).cast("int"))
    base = scratch_path(spark, "stream", "late")
    for first, last in ((0, LATE_SLICES // 2 - 1), (LATE_SLICES // 2, LATE_SLICES)):
        replay_files(env, f"{base}/bus", f"{base}/staged", "slice", first, last, files)
        stream = B.read_bus(spark, None, "parquet", f"{base}/bus", max_files_per_trigger=files)
        q = J.windowed_averages(stream, f"{base}/avg", f"{base}/checkpoint", state_partitions=1,
                                progress_path=f"{base}/progress")
        _await(q)
        store_progress(spark, f"{base}/progress", "windowed_averages").wait(q)
    m = stored_metrics(spark, f"{base}/progress")
    rows = m.filter("metric = 'stream_numInputRows' AND value > 0")
    found = rows.agg(F.countDistinct(F.col("labels")["query_id"], F.col("labels")["batch"]).alias("micro_batches"),
                     F.sum("value").cast("long").alias("input_rows")).crossJoin(late_rows(m).select("late_rows"))
    return found.select(F.expr("stack(3, 'micro_batches', micro_batches, 'input_rows', input_rows, 'late_rows', late_rows) "
                               "AS (metric, value)"))


@register("stream_pipeline_metrics", f"""
SELECT 'decoded_rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM events
UNION ALL
SELECT 'decoded_rejected' AS metric,
       CAST(SUM(CASE WHEN ({_REASON_SQL}) IS NOT NULL THEN 1 ELSE 0 END) AS DOUBLE) AS value FROM events""")
def q_stream_pipeline_metrics(spark, sf_dir):
    """K8: row and reject counts that every micro-batch stored, summed from the table."""
    env = _bus_records(spark, sf_dir, corrupt=True)
    base = _replay_run(spark, env, "metric_table",
                       lambda s, b, ck: J.readings_to_tables(s, f"{b}/raw", f"{b}/rejects", ck,
                                                             metrics_path=f"{b}/metrics"))
    return spark.read.parquet(f"{base}/metrics").groupBy("metric").agg(F.sum("value").alias("value"))


@register("stream_sql_insert", ORACLE["tumbling_avg_1m"])
def q_stream_sql_insert(spark, sf_dir):
    """A whole script on a stream: declared source and sink, INSERT."""

    def build(stream, b, ck):
        valid, _ = D.split_valid(J.decoded(stream))
        declare_stream(spark, "insert_source", valid, "ts", watermark="5 seconds")
        declare_sink("insert_target", f"{b}/avg", J.AVG_KEYS, ck, state_partitions=cluster_cores(spark))
        return run_sql(spark, "INSERT INTO insert_target " + tumbling_avg_sql("insert_source", exact_scale=SCALE))

    base = _replay_run(spark, _bus_records(spark, sf_dir), "sqlinsert", build)
    return _ntz(TB.read_table(spark, f"{base}/avg"), "window_start", "window_end")


@register("stream_sql_insert_bus", ORACLE["stream_averages_bus"])
def q_stream_sql_insert_bus(spark, sf_dir):
    """The script whose INSERT fills a topic: declared source with
    event time and watermark, declared topic with its columns, one statement.
    Columns go by position; each window is a JSON message, sent once when final."""

    def build(stream, b, ck):
        valid, _ = D.split_valid(J.decoded(stream))
        declare_stream(spark, "iot_sensor_data", valid, "ts", watermark="5 seconds")
        declare_topic("iot_windowed_data", "device_id STRING, window_start TIMESTAMP, window_end TIMESTAMP, avg_temp DOUBLE",
                      ck, path=f"{b}/topic", time_col="window_end", state_partitions=cluster_cores(spark))
        return run_sql(spark, f"""
            -- averages of each device and minute
            INSERT INTO iot_windowed_data
            SELECT device_id, window.start, window.end,
                   CAST(SUM(CAST(temperature AS DECIMAL(28,{SCALE}))) AS DOUBLE) / COUNT(temperature)
            FROM iot_sensor_data
            GROUP BY device_id, window(ts, '1 minute');""")

    base = _replay_run(spark, _bus_records(spark, sf_dir), "sqlinsertbus", build)
    return _windows_on_bus(spark, f"{base}/topic")


@register("stream_record_time_5m", f"""
WITH c AS ({CADENCE_SQL}), r AS (SELECT * REPLACE (ts + INTERVAL 7 MINUTE AS ts) FROM c)
SELECT device_id, {_bucket('ts', FIVE_MIN_US)} AS window_start, {_bucket('ts', FIVE_MIN_US, True)} AS window_end,
       max(ts) AS last_event_ts, {_exact_mean_sql('temperature')} AS avg_temp, COUNT(temperature) AS n
FROM r GROUP BY 1, 2, 3""")
def q_stream_record_time_5m(spark, sf_dir):
    """Windows on the bus record time, here seven minutes after the reading."""
    env = _bus_records(spark, sf_dir)
    env = env.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 7 MINUTES"))
    base = _replay_run(spark, env, "recordtime",
                       lambda s, b, ck: J.windowed_averages(s, f"{b}/avg", ck, "5 minutes", "0 seconds", parts=True,
                                                            state_partitions=cluster_cores(spark),
                                                            exact_scale=SCALE, time_source="record"))
    out = TB.read_table(spark, f"{base}/avg")
    return _ntz(out.select("device_id", "window_start", "window_end", "last_event_ts", "avg_temp", "n"),
                "window_start", "window_end", "last_event_ts")


def _stored_windows(spark, sf_dir, name: str) -> DataFrame:
    """One-minute averages of the readings as a stored keyed table."""
    path = scratch_path(spark, "table", name)
    r = X.cadence_readings(X.events(spark, sf_dir))
    TB.upsert_table(A.tumbling_avg(r, "device_id", "ts", "1 minute", exact_scale=SCALE), path, 0, J.AVG_KEYS)
    return TB.read_table(spark, path)


@register("serve_latest_windows", f"""
WITH w AS ({ORACLE["tumbling_avg_1m"]})
SELECT * FROM w WHERE device_id = 'device-3' ORDER BY window_start DESC LIMIT 50""")
def q_serve_latest_windows(spark, sf_dir):
    """Serving: the newest 50 windows of one device, from the stored table."""
    w = FL.key_equals(_stored_windows(spark, sf_dir, "serve_latest"), "device_id", "device-3")
    return _ntz(TN.latest_n(w, "device_id", "window_start", 50), "window_start", "window_end")


@register("serve_count_by_device", f"""
WITH w AS ({ORACLE["tumbling_avg_1m"]}) SELECT device_id, COUNT(*) AS record_count FROM w GROUP BY device_id""")
def q_serve_count_by_device(spark, sf_dir):
    """Serving: stored windows per device."""
    return A.count_by(_stored_windows(spark, sf_dir, "serve_count"), "device_id")


@register("serve_windows_in_range", f"""
WITH w AS ({ORACLE["tumbling_avg_1d_natural"]})
SELECT * EXCLUDE (n) FROM w WHERE window_start >= TIMESTAMP '2024-01-03' AND window_start < TIMESTAMP '2024-01-05'""")
def q_serve_windows_in_range(spark, sf_dir):
    """F4 on a stored table partitioned by day: the time range prunes its folders."""
    path = scratch_path(spark, "table", "serve_range")
    w = A.tumbling_avg(X.natural_readings(X.events(spark, sf_dir)), "device_id", "ts", "1 day", exact_scale=SCALE)
    w = w.withColumn("day", F.to_date("window_start"))
    m = TB.create_table_if_absent(spark, path, w.schema, J.AVG_KEYS, partition_by=["day"])
    TB.upsert_table(w, path, 0, manifest=m)
    out = FL.time_range(TB.read_table(spark, path), "window_start", "2024-01-03 00:00:00", "2024-01-05 00:00:00", partition="day")
    return _ntz(out.drop("day"), "window_start", "window_end")
