"""Recorded bus traffic as files, written in event-time order.

``replay_slices`` writes an envelope DataFrame as ``slices`` consecutive time
ranges, one distributed write each, and calls ``after_each`` between them --
typically an ``availableNow`` run of a streaming query that picks up only the
new files (its checkpoint remembers the rest).  That is the incremental-batch
way of running a stream, and it makes the micro-batch boundaries of a test
deterministic.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FILE = "_file"
#: With this on, a union of single partitions is one partition.
_UNION = "spark.sql.unionOutputPartitioning"


def replay_slices(env: DataFrame, path: str, slices: int = 3, time_col: str = "timestamp",
                  after_each: Callable[[int], None] | None = None, format: str = "parquet") -> int:
    """Write ``env`` to ``path`` in ``slices`` time-ordered appends.  Returns
    the number of slices written."""
    env = env.withColumn("_us", F.unix_micros(F.col(time_col)))
    lo_hi = env.agg(F.min("_us").alias("lo"), F.max("_us").alias("hi")).first()
    lo, hi = lo_hi["lo"], lo_hi["hi"]
    if lo is None:
        return 0
    width = (hi - lo) // slices + 1
    for i in range(slices):
        a, b = lo + i * width, lo + (i + 1) * width
        part = env.filter((F.col("_us") >= a) & (F.col("_us") < b)).drop("_us")
        part.write.mode("append").format(format).save(path)
        if after_each is not None:
            after_each(i)
    return slices


def replay_files(env: DataFrame, path: str, staged: str, slice_col: str, first: int = 0, last: int | None = None,
                 files: int = 1) -> int:
    """``files`` files for each value of ``slice_col`` in ``first..last`` (those
    that have rows), written one slice after another, so that a stream of
    ``files`` files a micro-batch meets one slice in each, in that order, and
    reads it with as many tasks.  The rows are dealt to slices and files once,
    under ``staged``; a second call, with the same ``files``, goes on from
    there.  A slice of fewer rows gets empty files.  Returns the number of
    files written."""
    spark = env.sparkSession
    if first == 0:
        dealt = env.withColumn(_FILE, F.monotonically_increasing_id() % files)
        dealt.repartition(slice_col, _FILE).write.partitionBy(slice_col, _FILE).parquet(staged)
    found: dict[int, list[int]] = {}
    for k, j in spark.read.parquet(staged).select(slice_col, _FILE).distinct().collect():  # ``files`` rows a slice
        found.setdefault(k, []).append(j)
    mine = [k for k in sorted(found) if k >= first and (last is None or k <= last)]
    schema = env.drop(slice_col).schema
    saved = spark.conf.get(_UNION, None)
    spark.conf.set(_UNION, "false")
    try:
        for k in mine:
            parts = [spark.read.schema(schema).parquet(f"{staged}/{slice_col}={k}/{_FILE}={j}").coalesce(1) for j in found[k]]
            reduce(DataFrame.unionAll, parts).write.mode("append").parquet(path)
            for _ in range(files - len(parts)):
                spark.createDataFrame([], schema).write.mode("append").parquet(path)
    finally:
        if saved is None:
            spark.conf.unset(_UNION)
        else:
            spark.conf.set(_UNION, saved)
    return files * len(mine)
