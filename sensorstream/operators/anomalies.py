"""Anomaly flags on window aggregates (X1, an extension).

The reference advertises anomaly detection but ships no code, so the rule is
ours: a window's value is anomalous when it differs from the mean of the
key's previous ``n`` windows by more than ``k`` sample standard deviations.
At least ``min_history`` previous windows are required; with a standard
deviation of 0 any change is anomalous.

Input is the *aggregated* window stream (one row per key and window).  Without
``bucket`` a key's whole history is sorted in one task: right for many keys of
moderate history.  With ``bucket`` it is split by time, and each bucket is given
the key's last ``n`` windows before it, however far back they lie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .timeseries import interval_ms


def _bucket_of(win: DataFrame, order: str, bucket) -> Column:
    """The bucket of a row: an interval for times, a width for numbers."""
    if isinstance(win.schema[order].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.floor(F.unix_micros(F.col(order).cast("timestamp")) / F.lit(interval_ms(bucket) * 1000))
    return F.floor(F.col(order) / F.lit(bucket))


def _with_history(win: DataFrame, keys: list[str], order: str, n: int, bucket) -> DataFrame:
    """``win`` with ``_b``, and for every bucket of a key copies (``_halo``) of
    the ``n`` rows before it.

    Only the last ``n`` rows of each bucket can be in a later one's history; a
    rank limit below the shuffle finds them, and one key's are few enough
    (``n`` a bucket) for the small window that deals them out.
    """
    rows = win.withColumn("_b", _bucket_of(win, order, bucket))
    last = Window.partitionBy(*keys, "_b").orderBy(F.desc(order))
    tails = rows.withColumn("_rn", F.row_number().over(last)).filter(F.col("_rn") <= n)
    by_key = Window.partitionBy(*keys).orderBy("_b", F.desc("_rn"))
    before = F.collect_list(F.struct(*(F.col(f"`{c}`") for c in win.columns))).over(by_key.rowsBetween(-n, -1))
    # A bucket's own tail begins after all that came before the bucket.
    starts = (tails.withColumn("_before", before).withColumn("_top", F.max("_rn").over(Window.partitionBy(*keys, "_b")))
              .filter(F.col("_rn") == F.col("_top")))
    halo = starts.select("_b", F.inline("_before")).select(*win.columns, "_b", F.lit(True).alias("_halo"))
    return rows.withColumn("_halo", F.lit(False)).unionByName(halo)


def anomalies(win: DataFrame, keys="device_id", order: str = "window_start",
              value: str = "avg_temp", n: int = 12, k: float = 3.0,
              min_history: int = 3, digits: int | None = 6, bucket=None) -> DataFrame:
    """``win`` with ``prev_n, prev_mean, prev_std, is_anomaly``.

    ``bucket`` (``"1 day"``; a number where ``order`` is one) splits a key's
    history; the flags are the same, means and deviations up to the last bits.
    Keys have one row for each ``order``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    split = [] if bucket is None else ["_b"]
    src = win if bucket is None else _with_history(win, keys, order, n, bucket)
    w = Window.partitionBy(*keys, *split).orderBy(order).rowsBetween(-n, -1)
    mean, std, cnt = F.avg(value).over(w), F.stddev_samp(value).over(w), F.count(value).over(w)
    out = (src.withColumn("prev_n", cnt)
              .withColumn("prev_mean", mean)
              .withColumn("prev_std", std))
    if bucket is not None:
        out = out.filter(~F.col("_halo")).drop("_halo", "_b")
    v, m, s = F.col(value), F.col("prev_mean"), F.col("prev_std")
    flag = (F.when(F.col("prev_n") < min_history, F.lit(False))
             .when(s == 0, v != m)
             .otherwise(F.abs(v - m) > F.lit(k) * s))
    out = out.withColumn("is_anomaly", F.coalesce(flag, F.lit(False)))
    if digits is not None:      # for show only: the flag compares unrounded values
        out = (out.withColumn("prev_mean", F.round("prev_mean", digits))
                  .withColumn("prev_std", F.round("prev_std", digits)))
    return out
