"""Grouped aggregates.

All of these are ``groupBy`` + built-in aggregates, so Spark plans them as a
partial aggregate before the shuffle and a final one after it: a device that
holds a third of all readings is reduced map-side to one row per window and
input partition before anything moves.  The tumbling-window operators group
by ``(keys, window)``, so even a hot key spreads over many reducers.

They work unchanged on a streaming DataFrame (with a watermark set, see
``streaming.windows``), which is how the same code serves batch and stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.math import exact_mean, exact_sum, safe_avg


def _mean(col: str, exact_scale: int | None) -> Column:
    return exact_mean(col, exact_scale) if exact_scale is not None else F.avg(col)


def _sum(col: str, exact_scale: int | None) -> Column:
    return exact_sum(col, exact_scale) if exact_scale is not None else F.sum(col).cast("double")


def _cols(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def _window_cols(win: str = "window") -> list[Column]:
    return [F.col(f"{win}.start").alias("window_start"), F.col(f"{win}.end").alias("window_end")]


def tumbling_agg(df: DataFrame, keys, ts: str, width: str,
                 aggs: dict[str, Column] | None = None) -> DataFrame:
    """Aggregate per key and epoch-aligned tumbling window of ``width``.

    Output: ``keys..., window_start, window_end, <aggs>``.  Default aggregate is
    ``avg_temp = avg(temperature)`` (NULL values ignored, as SQL ``AVG``).
    Rows with a NULL time fall into no window; guard them first with
    ``operators.decode.require_event_time``.
    """
    aggs = aggs or {"avg_temp": F.avg("temperature")}
    k = _cols(keys)
    return (df.groupBy(*k, F.window(ts, width).alias("window"))
              .agg(*[e.alias(n) for n, e in aggs.items()])
              .select(*k, *_window_cols(), *aggs.keys()))


def tumbling_avg(df: DataFrame, keys="device_id", ts: str = "ts", width: str = "1 minute",
                 value: str = "temperature", out: str = "avg_temp",
                 exact_scale: int | None = None) -> DataFrame:
    """A1: mean of ``value`` per key and window (SQL ``AVG``).  With
    ``exact_scale`` (values carry at most that many decimals) the sum is
    accumulated as a decimal, so the result does not depend on row order or on
    how partial aggregates are merged."""
    return tumbling_agg(df, keys, ts, width, {out: _mean(value, exact_scale)})


def tumbling_mean_parts(df: DataFrame, keys="device_id", ts: str = "ts", width: str = "5 minutes",
                        value: str = "temperature", exact_scale: int | None = None) -> DataFrame:
    """A2: reduce each window to (max time, sum, count), then a zero-guarded
    mean.  ``last_event_ts`` keeps the newest reading time of the window; the
    window bounds are the true ones."""
    parts = tumbling_agg(df, keys, ts, width, {
        "last_event_ts": F.max(ts),
        "sum_temp": _sum(value, exact_scale),
        "n": F.count(value),
    })
    return parts.withColumn("avg_temp", safe_avg("sum_temp", "n"))


def count_rows(df: DataFrame, out: str = "n") -> DataFrame:
    """A3: ``SELECT COUNT(*)``."""
    return df.agg(F.count(F.lit(1)).alias(out))


def count_by(df: DataFrame, keys, out: str = "record_count") -> DataFrame:
    """A4: rows per key."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(out))


def status_distribution(df: DataFrame, keys=None, status: str = "status") -> DataFrame:
    """A5: rows per status (per key, when given) and each status' share.

    With keys the share's denominator is a window over the *aggregated* rows
    (one per key and status), never over raw readings.  Without keys it is one
    number, the total of the aggregated rows, so no task holds all of them.
    """
    k = _cols(keys)
    counts = df.groupBy(*k, status).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*k)) if k else counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def trend(df: DataFrame, ts: str, bucket: str, cols: list[str], keys=None,
          exact_scale: int | None = None) -> DataFrame:
    """Per time bucket (and key), mean/min/max/count of each column."""
    aggs: dict[str, Column] = {}
    for c in cols:
        aggs[f"avg_{c}"] = _mean(c, exact_scale)
        aggs[f"min_{c}"] = F.min(c)
        aggs[f"max_{c}"] = F.max(c)
    aggs["n"] = F.count(F.lit(1))
    return tumbling_agg(df, _cols(keys), ts, bucket, aggs)
