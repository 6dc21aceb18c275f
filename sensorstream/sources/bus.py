"""Bus readers and writers (S1-S4, K1) over one envelope layout.

A live bus is read with Spark's Kafka source (``format="kafka"``); a replay
of recorded messages is read from Parquet/JSON files holding the same
envelope columns (``key, value, topic, partition, offset, timestamp``).  All
downstream operators only see the envelope, so both behave the same.

The Kafka connector jar is not part of this build environment: the
``kafka`` branch only maps options and is not exercised by the tests here.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import to_json_col
from ..schemas import ENVELOPE, SQL_TS_FORMAT
from .tables import _exists


def _topics(topics) -> list[str]:
    return [topics] if isinstance(topics, str) else list(topics)


def kafka_options(topics, bootstrap: str, start="earliest", group_id: str | None = None,
                  streaming: bool = True, extra: dict | None = None) -> dict[str, str]:
    """Options of Spark's Kafka source for S1-S4.

    ``start`` is ``"earliest"``, ``"latest"`` or a timestamp (datetime or epoch
    ms) mapped to ``startingTimestamp``.  Offsets that aged out of a topic fail
    the read unless the caller sets ``failOnDataLoss`` otherwise in ``extra``.  Consumer-group progress (S4) is the
    query's checkpoint, so ``group_id`` is only a label.
    """
    o = {"kafka.bootstrap.servers": bootstrap, "subscribe": ",".join(_topics(topics)),
         "failOnDataLoss": "true", "includeHeaders": "false"}
    if start == "latest" and not streaming:
        # A batch read can't start at "latest": it starts at the present time.
        o["startingTimestamp"] = str(int(_dt.datetime.now(_dt.timezone.utc).timestamp() * 1000))
        o["startingOffsetsByTimestampStrategy"] = "latest"
    elif isinstance(start, str) and start in ("earliest", "latest"):
        o["startingOffsets"] = start
    else:
        o["startingTimestamp"] = str(int(_to_dt(start).timestamp() * 1000))
    if not streaming:
        o["endingOffsets"] = "latest"
    if group_id:
        o["kafka.group.id"] = group_id
    o.update(extra or {})
    return o


def _to_dt(v) -> _dt.datetime:
    """datetime / ISO text / epoch ms -> aware UTC datetime (naive = UTC)."""
    if isinstance(v, int):
        return _dt.datetime.fromtimestamp(v / 1000, _dt.timezone.utc)
    d = v if isinstance(v, _dt.datetime) else _dt.datetime.fromisoformat(str(v).replace("Z", "+00:00"))
    return d if d.tzinfo else d.replace(tzinfo=_dt.timezone.utc)


def select_envelope(df: DataFrame, topics=None, start="earliest", start_col: str = "timestamp",
                    now: _dt.datetime | None = None) -> DataFrame:
    """Topic and start-position filters on a replayed envelope.

    ``latest`` keeps only records stamped at or after the reader's start
    (``now``), the file equivalent of skipping what is already on the topic.
    The bound is fixed when the reader is built; ``read_bus(checkpoint=)`` keeps
    it for restarts (a Kafka source keeps its offsets in the checkpoint).  Both filters reach the
    Parquet scan as pushed predicates.
    """
    out = df
    if topics is not None:
        out = out.filter(F.col("topic").isin(_topics(topics)))
    if start == "earliest" or start is None:
        return out
    bound = (now or _dt.datetime.now(_dt.timezone.utc)) if start == "latest" else _to_dt(start)
    # Session zone is UTC (session.ensure_utc): a naive UTC literal is exact.
    utc = bound.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return out.filter(F.col(start_col) >= F.lit(utc).cast("timestamp"))


def kept_start(spark: SparkSession, start, checkpoint: str | None, now: _dt.datetime | None = None):
    """The time that ``latest`` meant when a query first started.

    It is written beside the query's checkpoint and read back by every later
    start, so that a restart skips no record that came while the query was
    down.  Any other position is returned as it is."""
    if start != "latest" or checkpoint is None:
        return start
    path = f"{checkpoint}-start"
    if _exists(spark, path):
        kept = spark.read.schema("start string").json(path).limit(1).collect()
        if kept:
            return _to_dt(kept[0][0])
    start = now or _dt.datetime.now(_dt.timezone.utc)
    spark.createDataFrame([(start.isoformat(),)], "start string").coalesce(1).write.mode("overwrite").json(path)
    return start


def read_bus(spark: SparkSession, topics, format: str = "parquet", path: str | None = None,
             start="earliest", streaming: bool = True, bootstrap: str | None = None,
             max_files_per_trigger: int | None = None, checkpoint: str | None = None, **opts) -> DataFrame:
    """Read one or more topics as envelope rows (stream or batch).

    ``checkpoint`` is that of the query the stream is for: a file replay that
    starts at ``latest`` keeps the time there (:func:`kept_start`)."""
    reader = spark.readStream if streaming else spark.read
    if format == "kafka":
        if not bootstrap:
            raise ValueError("format='kafka' needs bootstrap servers")
        return reader.format("kafka").options(**kafka_options(topics, bootstrap, start,
                                                                streaming=streaming, extra=opts)).load()
    if path is None:
        raise ValueError("file replay needs a path")
    r = reader.schema(ENVELOPE).format(format)
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.options(**opts).load(path)
    return select_envelope(df, topics, kept_start(spark, start, checkpoint))


def to_envelope(df: DataFrame, topic: str, value: Column, key: Column | None = None,
                time_col: str | None = None) -> DataFrame:
    """Rows -> envelope (``value`` as UTF-8 bytes)."""
    return df.select(
        (key if key is not None else F.lit(None)).cast("binary").alias("key"),
        F.encode(value, "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("long").alias("offset"),
        (F.col(time_col) if time_col else F.current_timestamp()).cast("timestamp").alias("timestamp"),
    )


def encode_messages(df: DataFrame, cols: list[str], topic: str, ts_format: str = SQL_TS_FORMAT,
                    key_col: str | None = None, time_col: str | None = None) -> DataFrame:
    """P7 + K1: rows -> JSON messages in the envelope of ``topic``."""
    key = F.col(key_col).cast("string") if key_col else None
    return to_envelope(df, topic, to_json_col(cols, ts_format), key, time_col)


def write_bus(df: DataFrame, topic: str, format: str = "parquet", path: str | None = None,
              bootstrap: str | None = None):
    """K1 (batch form): append envelope rows to a topic or its file replay.
    Streams use ``streaming.sinks.bus_sink``."""
    if format == "kafka":
        (df.select("key", "value").write.format("kafka")
           .option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())
        return
    df.write.mode("append").format(format).save(path)
