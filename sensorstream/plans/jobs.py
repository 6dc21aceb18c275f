"""End-to-end jobs: the reference's three deployments as Spark queries.

* ``readings_to_tables``      decode the bus, store raw readings (keyed table)
                              and rejects (quarantine): stateless, one query.
* ``windowed_averages``       decode -> watermark -> tumbling average -> keyed
                              averages table (``update``) or a bus topic
                              (``append``, each window once when final).
* ``route_topics_to_tables``  one reader over several topics, dispatched by
                              topic to per-topic decoders and tables; unknown
                              topics are quarantined.
* ``averages_to_bus``         windows as JSON messages on an append-only topic
                              (each window once, when the watermark closes it).

All take a streaming envelope (``sources.bus.read_bus``) and a checkpoint
path; run them with ``trigger="availableNow"`` for scheduled incremental
runs or a processing-time trigger for a continuous job.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.time import parse_any_ts
from ..operators import decode as D
from ..schemas import DEFAULT_TOPIC_AVERAGES, DEFAULT_TOPIC_READINGS, ROUTED_WIRE, WINDOW_AVG_WIRE
from ..sources.tables import make_folder
from ..streaming import sinks as S
from ..streaming.runner import observe_counts, start_query
from ..streaming.windows import windowed_average, windowed_mean_parts

RAW_KEYS = ["device_id", "ts"]
AVG_KEYS = ["device_id", "window_start"]
#: Newest version of a key: by record time; offsets of two partitions do not compare.
BUS_ORDER = ["record_ts", "bus_partition", "bus_offset"]
READING_COLS = ["device_id", "ts", "temperature", "humidity", "status", *BUS_ORDER]
AVG_COLS = ["device_id", "window_start", "window_end", "avg_temperature", *BUS_ORDER]


def _positioned(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"offset": "bus_offset", "partition": "bus_partition"})


def decoded(envelope: DataFrame, time_mode: str = "sql", required=("device_id", "timestamp", "temperature"),
            max_skew: str | None = None, on_null_time: str = "quarantine",
            time_source: str = "payload") -> DataFrame:
    """Envelope -> flagged readings with their place on the bus
    (``record_ts``, ``bus_partition``, ``bus_offset``)."""
    return _positioned(D.decode_readings(envelope, required=required, time_mode=time_mode, max_skew=max_skew,
                                         on_null_time=on_null_time, time_source=time_source, keep_record=True))


def _rejects(df: DataFrame) -> DataFrame:
    return df.select("topic", F.col("bus_partition").alias("partition"), F.col("bus_offset").alias("offset"),
                     D.REASON, "raw")


def _split_valid(df: DataFrame) -> dict[str, DataFrame]:
    valid, rejected = D.split_valid(df)
    return {"valid": valid.select(*READING_COLS), "rejected": _rejects(rejected), "metrics": df}


def readings_to_tables(envelope: DataFrame, raw_path: str, rejects_path: str, checkpoint: str,
                       trigger="availableNow", time_mode: str = "sql", observe: bool = True,
                       on_null_time: str = "quarantine", metrics_path: str | None = None) -> StreamingQuery:
    """Raw readings table (key device_id, ts; newest bus record wins) + rejects.
    With ``observe`` each micro-batch reports its row and reject counts in the
    query progress (``observedMetrics.decode_counts``); with ``metrics_path``
    it also stores them as METRIC rows, which outlive the query."""
    targets = {"valid": S.upsert_sink(raw_path, RAW_KEYS, BUS_ORDER), "rejected": S.quarantine_sink(rejects_path)}
    if metrics_path:
        targets["metrics"] = S.metrics_sink(metrics_path, "readings_to_tables")
    d = decoded(envelope, time_mode, on_null_time=on_null_time)
    if observe:
        d = observe_counts(d)
    return start_query(d, S.split_sink(_split_valid, targets), "readings_to_tables", checkpoint, "append", trigger)


LOG_COLS = [*READING_COLS, "topic", D.REASON, "raw"]


def decoded_log(envelope: DataFrame, log_path: str, checkpoint: str, trigger="availableNow",
                name: str = "decoded_log", **decode_options) -> StreamingQuery:
    """The bus read and parsed once: flagged readings as an append-only log.

    Spark's file sink commits each micro-batch as a whole, and a stream over
    its folder (:func:`read_log`) sees committed files only, each once: a chain
    of queries that is exactly-once from end to end."""
    rows = observe_counts(decoded(envelope, **decode_options)).select(*LOG_COLS)
    # The sink's commit log exists before any reader looks for it.
    make_folder(envelope.sparkSession, f"{log_path}/_spark_metadata")
    return start_query(rows, None, name, checkpoint, "append", trigger,
                       writer=rows.writeStream.format("parquet").option("path", log_path))


def read_log(envelope: DataFrame, log_path: str, **decode_options) -> DataFrame:
    """The log of :func:`decoded_log` as a stream of flagged readings."""
    schema = decoded(envelope, **decode_options).select(*LOG_COLS).schema
    return envelope.sparkSession.readStream.schema(schema).parquet(log_path)


def _valid_for_windows(envelope: DataFrame, name: str, checkpoint: str, trigger, rejects_path: str | None,
                       metrics_path: str | None, raw_path: str | None = None, **decode_options) -> DataFrame:
    """Valid readings for a windowed job.

    An aggregating query has one output.  Where the raw readings or the rejects
    are kept too, the bus is therefore read by one query, which logs the decoded
    rows; a stateless query over that log fills the tables, and the windows are
    computed from the log as well.  Messages are read and parsed once.  An
    incremental run waits for the first two."""
    if not (rejects_path or raw_path):
        return D.split_valid(observe_counts(decoded(envelope, **decode_options)))[0]
    log = f"{checkpoint}-log"
    targets = {}
    if raw_path:
        targets["valid"] = S.upsert_sink(raw_path, RAW_KEYS, BUS_ORDER)
    if rejects_path:
        targets["rejected"] = S.quarantine_sink(rejects_path)
    if metrics_path:
        targets["metrics"] = S.metrics_sink(metrics_path, f"{name}_kept")
    steps = (lambda: decoded_log(envelope, log, f"{checkpoint}-log-checkpoint", trigger, f"{name}_log", **decode_options),
             lambda: start_query(read_log(envelope, log, **decode_options), S.split_sink(_split_valid, targets), f"{name}_kept",
                                 f"{checkpoint}-kept", "append", trigger))
    for start in steps:
        q = start()
        if trigger == "availableNow":
            q.awaitTermination()
    return D.split_valid(read_log(envelope, log, **decode_options))[0]


def windowed_averages(envelope: DataFrame, out_path: str, checkpoint: str, width: str = "1 minute",
                      delay: str = "5 seconds", mode: str = "update", trigger="availableNow",
                      time_mode: str = "sql", parts: bool = False,
                      max_skew: str | None = None, state_partitions: int | None = None,
                      exact_scale: int | None = None, rejects_path: str | None = None,
                      metrics_path: str | None = None, on_null_time: str = "quarantine",
                      time_source: str = "payload", progress_path: str | None = None,
                      raw_path: str | None = None) -> StreamingQuery:
    """Valid readings -> per-device tumbling average -> keyed averages table.

    ``mode="update"`` rewrites a window whenever it changes (the table is
    always current); ``mode="append"`` writes each window once, when the
    watermark passes its end.  ``parts=True`` is the (max ts, sum, count)
    variant with its zero-guarded mean.  Rejects are counted in the query
    progress; ``rejects_path`` and ``raw_path`` keep them and the raw readings
    (keyed table) from the same reading of the bus.
    ``time_source="record"`` windows on the bus record time.  ``progress_path``
    stores input rows, rates and late rows of every micro-batch.
    """
    valid = _valid_for_windows(envelope, "windowed_averages", checkpoint, trigger, rejects_path, metrics_path, raw_path,
                               time_mode=time_mode, max_skew=max_skew, on_null_time=on_null_time,
                               time_source=time_source)
    agg = (windowed_mean_parts(valid, "device_id", "ts", width, delay, exact_scale=exact_scale) if parts
           else windowed_average(valid, "device_id", "ts", width, delay, exact_scale=exact_scale))
    return start_query(agg, S.upsert_sink(out_path, AVG_KEYS), "windowed_averages", checkpoint,
                       mode, trigger, no_data_batches=(mode != "update"), state_partitions=state_partitions,
                       progress_path=progress_path)


def check_averages(d: DataFrame) -> DataFrame:
    """Flag and type the decoded fields of window-average messages."""
    d = D.require_fields(d, ["device_id", "window_start", "window_end", "avg_temperature"])
    d = D.coerce(d, {"avg_temperature": "double"})
    d = d.withColumn("window_start", parse_any_ts("window_start")) \
         .withColumn("window_end", parse_any_ts("window_end"))
    return D._flag(d, F.col("window_start").isNull() | F.col("window_end").isNull(), "bad_time")


def decode_averages(df: DataFrame) -> DataFrame:
    """Window-average messages (the averages topic) -> typed rows with the
    same ``reject_reason`` flags as readings (split with ``split_valid``)."""
    d = D.decode_json(df, WINDOW_AVG_WIRE, keep=D.ENVELOPE_META + ("timestamp",))
    return _positioned(check_averages(D.flag_malformed(d)))


#: What the routed consumer asks of a reading.
ROUTED_READING = ("device_id", "timestamp", "temperature", "humidity", "status")


def route_topics_to_tables(envelope: DataFrame, raw_path: str, avg_path: str, rejects_path: str,
                           checkpoint: str, trigger="availableNow",
                           readings_topic: str = DEFAULT_TOPIC_READINGS,
                           averages_topic: str = DEFAULT_TOPIC_AVERAGES,
                           on_null_time: str = "quarantine") -> StreamingQuery:
    """The consumer: one query over both topics.  Each message is parsed once;
    the parsed micro-batch is persisted and routed by topic.  Valid rows go to
    their keyed tables, and every reject -- unknown topic, bad reading, bad
    average -- goes to the quarantine in one write per batch.  A reading needs
    all its fields, an average both its window bounds."""
    from ..operators.filters import route, split_routes

    raw_sink = S.upsert_sink(raw_path, RAW_KEYS, BUS_ORDER)
    avg_sink = S.upsert_sink(avg_path, AVG_KEYS, BUS_ORDER)
    bad_sink = S.quarantine_sink(rejects_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        d = _positioned(D.flag_malformed(D.decode_json(batch, ROUTED_WIRE, keep=D.ENVELOPE_META + ("timestamp",))))
        d.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tagged = route(d, {readings_topic: "readings", averages_topic: "averages"})
            parts = split_routes(tagged, ["readings", "averages", "rejected"])
            r_ok, r_bad = D.split_valid(D.check_readings(parts["readings"], ROUTED_READING, "any", on_null_time))
            a_ok, a_bad = D.split_valid(check_averages(parts["averages"]))
            raw_sink(r_ok.select(*READING_COLS), batch_id)
            avg_sink(a_ok.select(*AVG_COLS), batch_id)
            unknown = parts["rejected"].withColumn(D.REASON, F.lit("unknown_topic"))
            bad_sink(_rejects(r_bad).unionByName(_rejects(a_bad)).unionByName(_rejects(unknown)), batch_id)
        finally:
            d.unpersist()

    return start_query(envelope, write, "route_topics_to_tables", checkpoint, "append", trigger)


def averages_to_bus(envelope: DataFrame, out_path: str, checkpoint: str, topic: str = "iot_windowed_data",
                    width: str = "1 minute", delay: str = "5 seconds", trigger="availableNow",
                    time_mode: str = "sql", format: str = "parquet",
                    bootstrap: str | None = None, state_partitions: int | None = None,
                    exact_scale: int | None = None, rejects_path: str | None = None,
                    metrics_path: str | None = None, on_null_time: str = "quarantine",
                    time_source: str = "payload") -> StreamingQuery:
    """V2: valid readings -> watermark -> tumbling average -> JSON messages on
    an append-only topic.  Each window is written once, when the watermark
    passes its end (windows still open at the end of a run stay in state)."""
    from ..sources.bus import encode_messages
    from ..streaming.sinks import bus_sink

    valid = _valid_for_windows(envelope, "averages_to_bus", checkpoint, trigger, rejects_path, metrics_path,
                               time_mode=time_mode, on_null_time=on_null_time, time_source=time_source)
    agg = windowed_average(valid, "device_id", "ts", width, delay, exact_scale=exact_scale)
    msgs = encode_messages(agg, ["device_id", "window_start", "window_end", "avg_temp"], topic,
                           time_col="window_end")
    writer = bus_sink(msgs, out_path, topic, format, bootstrap)
    return start_query(msgs, None, "averages_to_bus", checkpoint, "append", trigger, writer=writer,
                       state_partitions=state_partitions)
