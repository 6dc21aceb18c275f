"""Event time, watermarks and windowed stream aggregates.

The aggregation operators in ``operators.aggregates`` are used unchanged on
streams; this module adds what only a stream needs: which column is event
time (payload or bus record time, W6), the allowed disorder (W1/W2; none on
stateless stages, W3), and a guard against readings from the far future that
would otherwise push the global watermark ahead and close every device's
windows early.

Emission (W4/W5/W7), as Spark implements it:
* ``append``: a window is emitted once, when ``watermark >= window end``;
  rows older than the watermark of the *previous* micro-batch are dropped and
  counted in ``stateOperators[].numRowsDroppedByWatermark`` (after partial
  aggregation, so a lower bound on late rows).
* ``update``: a window is re-emitted whenever it changes; paired with the
  keyed-table sink (last write wins) the table always holds the current value
  and no window is held back at the end of an ``availableNow`` run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators.decode import _flag


def event_time(df: DataFrame, source: str = "payload", payload_col: str = "ts",
               record_col: str = "timestamp", out: str = "ts") -> DataFrame:
    """Use the reading's own time (``payload``) or the bus record time."""
    if source == "payload":
        return df if payload_col == out else df.withColumn(out, F.col(payload_col))
    if source == "record":
        return df.withColumn(out, F.col(record_col).cast("timestamp"))
    raise ValueError(f"unknown time source: {source}")


def watermark(df: DataFrame, ts: str = "ts", delay: str = "5 seconds") -> DataFrame:
    """Bounded disorder ``delay`` (``"0 seconds"`` = in-order input)."""
    return df.withWatermark(ts, delay)


def guard_future(df: DataFrame, ts: str = "ts", record_col: str = "record_ts",
                 max_skew: str = "1 hour") -> DataFrame:
    """Flag readings stamped more than ``max_skew`` after their bus record time
    (``future_time``); they go to the rejects instead of the watermark."""
    bad = F.col(ts) > F.col(record_col) + F.expr(f"INTERVAL {max_skew}")
    return _flag(df, bad, "future_time")


def windowed_average(readings: DataFrame, keys="device_id", ts: str = "ts",
                     width: str = "1 minute", delay: str | None = "5 seconds",
                     value: str = "temperature", out: str = "avg_temp",
                     exact_scale: int | None = None) -> DataFrame:
    """A1 + W1/W4 for batch and stream alike (watermark only on streams)."""
    src = watermark(readings, ts, delay) if (delay is not None and readings.isStreaming) else readings
    return A.tumbling_avg(src, keys, ts, width, value, out, exact_scale)


def windowed_mean_parts(readings: DataFrame, keys="device_id", ts: str = "ts",
                        width: str = "5 minutes", delay: str | None = "0 seconds",
                        value: str = "temperature", exact_scale: int | None = None) -> DataFrame:
    """A2 + W2 (the in-order variant with 5-minute windows)."""
    src = watermark(readings, ts, delay) if (delay is not None and readings.isStreaming) else readings
    return A.tumbling_mean_parts(src, keys, ts, width, value, exact_scale)
