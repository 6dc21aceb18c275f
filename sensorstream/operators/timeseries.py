"""Metric series: counter rate (N1), instant values (N2), sums by label (A7,
N3).

Semantics (ours; the reference only names these dashboard queries):

* ``counter_rate``: for each sample at time t, the increase of the counter
  over the samples in ``(t - range, t]`` -- the sum of the increments between
  consecutive samples inside that frame, an increment being ``v - prev`` or,
  after a reset (``v < prev``), ``v`` itself -- divided by the range in
  seconds.  The first sample of a frame is its baseline; no extrapolation to
  the frame edges.  A NULL, NaN or infinite sample is no reading of the counter: it is
  neither baseline nor end of an increment, and its own row still gets the rate
  of its frame (NULL if the frame holds no reading).
* ``at_steps``: the instant value of a series at step time t is its newest
  sample in ``(t - step, t]`` (look-back = step).
* ``sum_by``: sum of the instant values of all series sharing a label value,
  per step.

Scale: a plain ``Window.partitionBy(series)`` would sort all samples of a
series in one task; a series holding a third of all samples would then be a
third of the job in one task.  ``counter_rate`` instead partitions by
``(series, time bucket)`` and gives each bucket a halo copy of the previous
bucket's last ``range`` of samples: one shuffle, parallelism series x buckets,
``range / bucket`` of the input duplicated.  No window slides: the frames are
running ones, so dense samples (many in a range) cost no more than sparse ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.math import exact_sum, newest_order

_UNIT_MS = {"ms": 1, "millisecond": 1, "s": 1000, "sec": 1000, "second": 1000, "min": 60_000,
            "minute": 60_000, "h": 3_600_000, "hr": 3_600_000, "hour": 3_600_000, "d": 86_400_000,
            "day": 86_400_000}


def interval_ms(text: str) -> int:
    """'5 minutes' -> 300000 (units: ms, s/sec/second, min/minute, h/hr/hour,
    d/day; plural forms accepted)."""
    n, unit = text.strip().split(None, 1)
    u = unit.strip().lower()
    if u not in _UNIT_MS and u.endswith("s"):
        u = u[:-1]
    if u not in _UNIT_MS:
        raise ValueError(f"unknown interval unit in {text!r}")
    return int(float(n) * _UNIT_MS[u])


#: Decimal places of the sums over counter resets.
RESET_SCALE = 9


def _cols(c) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


def counter_rate(df: DataFrame, series, ts: str = "ts", value: str = "value",
                 range_: str = "5 minutes", bucket: str = "1 hour", out: str = "rate") -> DataFrame:
    """``rate(counter[range])`` evaluated at every sample (see module doc).

    One shuffle on ``(series, bucket)``; the bucket also receives, as a halo,
    the previous bucket's samples of the last ``range``.  Two sorted passes of a
    partition, each with running windows only, so the time does not grow with
    the number of samples in a frame:

    * upwards, each sample gets the newest reading so far and the sum of the
      readings that were lost to resets so far;
    * downwards, a question stands at each sample's frame start, and its answer
      is the reading met last before it: the frame's first, its baseline.

    The increments between two readings add up to their difference plus what
    resets took in between.  That is a difference of two running sums; they are
    decimals with ``RESET_SCALE`` places, exact whatever they began with, so the
    result has the same bits for any bucket size.  (A sum over 1e29 raises.)
    """
    s = _cols(series)
    r_ms = interval_ms(range_)
    b_ms = max(interval_ms(bucket), r_ms)
    payload = F.struct(*(F.col(f"`{c}`") for c in df.columns if c not in s)).alias("_row")
    ms = F.unix_millis(F.col(ts))
    number = F.col(value).cast("double")
    v = F.when(~F.isnan(number) & (F.abs(number) != F.lit(float("inf"))), number)
    e = (df.select(*s, ms.alias("_ms"), F.col(value).alias("_as"), v.alias("_v"), payload)
           .withColumn("_b", F.floor(F.col("_ms") / F.lit(b_ms))))
    in_halo = F.col("_ms") > (F.col("_b") + 1) * F.lit(b_ms) - F.lit(r_ms)
    targets = F.when(in_halo, F.array(F.col("_b"), F.col("_b") + 1)).otherwise(F.array(F.col("_b")))
    h = e.withColumn("_tb", F.explode(targets))
    part = Window.partitionBy(*s, "_tb")
    up = part.orderBy("_ms", "_as")
    before = F.last("_v", ignorenulls=True).over(up.rowsBetween(Window.unboundedPreceding, -1))
    lost = F.coalesce(F.sum(F.when(F.col("_v") < F.col("_p"), F.col("_p").cast(f"decimal(38,{RESET_SCALE})")))
                      .over(up.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0).cast(f"decimal(38,{RESET_SCALE})"))
    h = h.withColumn("_p", before).withColumn("_lost", lost)
    reading = F.when(F.col("_v").isNotNull(), F.struct(F.col("_ms").alias("ms"), F.col("_v").alias("v"), F.col("_lost").alias("lost")))
    # Samples of the same moment share a frame, so its newest reading is theirs.
    h = h.withColumn("_reading", reading).withColumn(
        "_new", F.last("_reading", ignorenulls=True).over(part.orderBy("_ms").rangeBetween(Window.unboundedPreceding, 0)))
    # Each sample is met as a reading; one of this bucket also asks at its frame's start.
    met = F.struct(F.col("_ms").alias("at"), F.lit(True).alias("met"), F.col("_reading").alias("met_reading"),
                   F.lit(None).cast(h.schema["_reading"].dataType).alias("new"), F.lit(None).cast(h.schema["_row"].dataType).alias("row"))
    asks = F.struct((F.col("_ms") - r_ms).alias("at"), F.lit(False).alias("met"), F.lit(None).cast(h.schema["_reading"].dataType).alias("met_reading"),
                    F.col("_new").alias("new"), F.col("_row").alias("row"))
    both = h.select(*s, "_tb", F.inline(F.when(F.col("_tb") == F.col("_b"), F.array(met, asks)).otherwise(F.array(met))))
    down = part.orderBy(F.desc("at"), "met", F.desc("met_reading.v"))
    first = F.last("met_reading", ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, 0))
    res = both.withColumn("_first", first).filter(~F.col("met"))
    taken = (F.col("new.lost") - F.col("_first.lost")).cast("double")
    gain = F.when(taken == 0, F.col("new.v") - F.col("_first.v")).otherwise(taken - F.col("_first.v") + F.col("new.v"))
    rate = F.when(F.col("new.ms") > F.col("at"), gain / F.lit(r_ms / 1000.0))
    return res.select(*(F.col(c) if c in s else F.col(f"row.`{c}`").alias(c) for c in df.columns), rate.alias(out))


def gauge_at(df: DataFrame, series, at, ts: str = "ts", value: str = "value",
             lookback: str = "5 minutes") -> DataFrame:
    """Newest sample of each series in ``(at - lookback, at]``."""
    s = _cols(series)
    at_c = F.lit(at).cast("timestamp")
    lb = F.expr(f"INTERVAL {interval_ms(lookback)} MILLISECONDS")
    f = df.filter((F.col(ts) <= at_c) & (F.col(ts) > at_c - lb))
    return f.groupBy(*s).agg(F.max(ts).alias("ts"), _newest(ts, value).alias("value"))


def _newest(ts: str, value: str) -> Column:
    """The value at the newest time, of several the greatest."""
    return F.max_by(F.col(value), newest_order(F.col(ts), F.col(value).cast("double")))


def step_end(ts: str, step_ms: int) -> Column:
    """Smallest multiple of the step that is >= ts (a sample at exactly t
    belongs to step t)."""
    ms = F.unix_millis(F.col(ts))
    return F.timestamp_millis((F.floor((ms - 1) / F.lit(step_ms)) + 1) * F.lit(step_ms))


def at_steps(df: DataFrame, series, step: str = "1 minute", ts: str = "ts",
             value: str = "value") -> DataFrame:
    """Instant value of every series at every step (partial aggregate)."""
    s = _cols(series)
    st = interval_ms(step)
    return (df.groupBy(*s, step_end(ts, st).alias("step_ts"))
              .agg(_newest(ts, value).alias(value)))


def sum_by(df: DataFrame, by, series, step: str = "1 minute", ts: str = "ts",
           value: str = "value", out: str = "value", exact_scale: int | None = None) -> DataFrame:
    """``sum(x) by (label)`` evaluated at every step.  ``exact_scale``
    sums as a decimal of that scale (order-independent result)."""
    s = _cols(series)
    s += [b for b in _cols(by) if b not in s]   # grouping labels identify the series too
    inst = at_steps(df, s, step, ts, value)
    total = exact_sum(value, exact_scale) if exact_scale is not None else F.sum(value)
    return inst.groupBy(*_cols(by), "step_ts").agg(total.alias(out))
