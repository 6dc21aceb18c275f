"""Adapters from the driver's ``events`` table to the library's inputs.

Every adapter is a pure projection of ``events`` (one scan, no shuffle), so
its size grows with the table.  The same definitions are written as DuckDB
SQL in ``sensorstream.queries`` (the oracle side).

events(event_id, ts TIMESTAMP_NTZ, user_id, event_type, value, props '{"k": n}')
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import format_ts
from ..schemas import DEFAULT_TOPIC_AVERAGES, DEFAULT_TOPIC_READINGS, ISO_TS_FORMAT

# Fixed values of the fixture definitions (FIXTURES.md section 2).
CADENCE_ORIGIN_MS = 1704067200000      # 2024-01-01 00:00:00 UTC
CADENCE_STEP_MS = 200                  # 10 devices, one reading each per 2 s
CADENCE_DEVICES = 10
BUS_PARTITIONS = 3
CORRUPT_NOT_JSON = 97
CORRUPT_NO_TIMESTAMP = 101
CORRUPT_ISO_TIME = 103
CORRUPT_NO_TEMPERATURE = 107
CORRUPT_QUOTED_TEMPERATURE = 109
TOPIC_AVERAGES_EVERY = 5
TOPIC_UNKNOWN_EVERY = 13
UNKNOWN_TOPIC = "unknown_topic"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``events`` table, split as its files and
    ``spark.sql.files.maxPartitionBytes`` say."""
    return table(spark, sf_dir, "events")


def dealt(ev: DataFrame, parts: int) -> DataFrame:
    """``ev`` dealt evenly to ``parts`` tasks.  The table's files follow the time,
    so without this a time range is encoded and written by the few tasks whose
    files it lies in, and its few files are read by as few."""
    return ev.repartition(parts, "event_id")


def _status() -> Column:
    return (F.when(F.col("event_type") == "error", F.lit("FAIL"))
            .when(F.col("event_type") == "purchase", F.lit("WARN"))
            .otherwise(F.lit("OK")))


def _humidity() -> Column:
    return F.get_json_object("props", "$.k").try_cast("double")


def cadence_ts() -> Column:
    return F.timestamp_millis(F.lit(CADENCE_ORIGIN_MS) + F.col("event_id") * CADENCE_STEP_MS)


def cadence_device() -> Column:
    return F.concat(F.lit("device-"), (F.col("event_id") % CADENCE_DEVICES + 1).cast("string"))


def natural_readings(ev: DataFrame) -> DataFrame:
    """One device per user, the table's own (irregular) event times."""
    return ev.select(
        F.concat(F.lit("device-"), F.col("user_id").cast("string")).alias("device_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("temperature"),
        _humidity().alias("humidity"),
        _status().alias("status"),
    )


def cadence_readings(ev: DataFrame, with_event_id: bool = False) -> DataFrame:
    """Ten devices, one reading each every 2 s (the reference's producer)."""
    cols = [
        cadence_device().alias("device_id"),
        cadence_ts().alias("ts"),
        F.col("value").alias("temperature"),
        _humidity().alias("humidity"),
        _status().alias("status"),
    ]
    if with_event_id:
        cols = [F.col("event_id")] + cols
    return ev.select(*cols)


def colliding_readings(ev: DataFrame) -> DataFrame:
    """Cadence rows with time cut to the minute: ~30 versions per key; the
    order column ``event_id`` says which version was written last."""
    r = cadence_readings(ev, with_event_id=True)
    return r.withColumn("ts", F.date_trunc("minute", "ts"))


def _reading_json(ts_text: Column, temperature: Column | None, with_ts: bool = True) -> Column:
    fields = [cadence_device().alias("device_id")]
    if with_ts:
        fields.append(ts_text.alias("timestamp"))
    if temperature is not None:
        fields.append(temperature.alias("temperature"))
    fields += [_humidity().alias("humidity"), _status().alias("status")]
    return F.to_json(F.struct(*fields))


def message_text(corrupt: bool = False) -> Column:
    """JSON text of a cadence reading; with ``corrupt`` a deterministic share of
    messages is broken (first matching rule wins)."""
    sql_ts = format_ts(cadence_ts(), "sql_ms")
    good = _reading_json(sql_ts, F.col("value"))
    if not corrupt:
        return good
    eid = F.col("event_id")
    return (F.when(eid % CORRUPT_NOT_JSON == 0, F.lit("not json"))
            .when(eid % CORRUPT_NO_TIMESTAMP == 0, _reading_json(sql_ts, F.col("value"), with_ts=False))
            .when(eid % CORRUPT_ISO_TIME == 0,
                  _reading_json(F.date_format(cadence_ts(), ISO_TS_FORMAT), F.col("value")))
            .when(eid % CORRUPT_NO_TEMPERATURE == 0, _reading_json(sql_ts, None))
            .when(eid % CORRUPT_QUOTED_TEMPERATURE == 0,
                  _reading_json(sql_ts, F.col("value").cast("string")))
            .otherwise(good))


def _average_json() -> Column:
    start = F.date_trunc("minute", cadence_ts())
    return F.to_json(F.struct(
        cadence_device().alias("device_id"),
        format_ts(start, "sql_ms").alias("window_start"),
        format_ts(start + F.expr("INTERVAL 1 MINUTE"), "sql_ms").alias("window_end"),
        F.col("value").alias("avg_temperature"),
    ))


def topic_of(two_topics: bool) -> Column:
    if not two_topics:
        return F.lit(DEFAULT_TOPIC_READINGS)
    eid = F.col("event_id")
    return (F.when(eid % TOPIC_AVERAGES_EVERY == 0, F.lit(DEFAULT_TOPIC_AVERAGES))
            .when(eid % TOPIC_UNKNOWN_EVERY == 0, F.lit(UNKNOWN_TOPIC))
            .otherwise(F.lit(DEFAULT_TOPIC_READINGS)))


def messages(ev: DataFrame, corrupt: bool = False, two_topics: bool = False) -> DataFrame:
    """Bus records in the Kafka-source envelope.  No message key, as the
    reference's producers send none; record time = reading time."""
    topic = topic_of(two_topics)
    text = message_text(corrupt)
    if two_topics:
        text = F.when(topic == DEFAULT_TOPIC_AVERAGES, _average_json()).otherwise(text)
    return ev.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode(text, "UTF-8").alias("value"),
        topic.alias("topic"),
        (F.col("event_id") % BUS_PARTITIONS).cast("int").alias("partition"),
        F.floor(F.col("event_id") / BUS_PARTITIONS).cast("long").alias("offset"),
        cadence_ts().alias("timestamp"),
    )


# Metric series derived from the cadence readings: one counter and one gauge
# per device.  Labels: namespace, pod = device id, container (absent for every
# third device, so that "missing" and "" behave the same in label matching).
COUNTER_METRIC = "sensor_readings_total"
GAUGE_METRIC = "sensor_temperature"
COUNTER_WRAP = 50
NAMESPACE_MAIN = "iot-pipeline"
NAMESPACE_OTHER = "default"


def metrics(ev: DataFrame) -> DataFrame:
    dev = F.col("event_id") % CADENCE_DEVICES + 1
    container = F.when(dev % 3 == 1, F.lit("sensor")).when(dev % 3 == 2, F.lit("POD"))
    ns = F.when(dev <= 8, F.lit(NAMESPACE_MAIN)).otherwise(F.lit(NAMESPACE_OTHER))
    labels = F.map_filter(
        F.create_map(F.lit("namespace"), ns, F.lit("pod"), cadence_device(),
                     F.lit("container"), container),
        lambda k, v: v.isNotNull())
    counter = (F.floor(F.col("event_id") / CADENCE_DEVICES) % COUNTER_WRAP).cast("double")
    samples = F.array(
        F.struct(F.lit(COUNTER_METRIC).alias("metric"), counter.alias("value")),
        F.struct(F.lit(GAUGE_METRIC).alias("metric"), F.col("value").alias("value")),
    )
    return (ev.select(labels.alias("labels"), cadence_ts().alias("ts"), F.inline(samples))
              .select("metric", "labels", "ts", "value"))
