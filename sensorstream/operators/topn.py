"""Newest-n per key (L1) and ordered head (L2).

Per key, newest-n is ``row_number() <= n``; Catalyst turns the filter into a
``WindowGroupLimit`` that also runs *before* the shuffle, so a hot key ships
at most ``n`` rows per input partition.

A global top-n (no keys) would normally be ``ORDER BY ... LIMIT n``, whose
plan (``TakeOrderedAndProject``) sends ``n`` rows from every input partition
into one task: ``n x partitions`` rows, growing with the input.  Here it is
two-level: input partitions are grouped (``spark_partition_id() % groups``),
each group keeps its top ``n`` (again with a pre-shuffle ``WindowGroupLimit``),
and only ``groups x n`` rows reach the final ordered limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

GROUPS = 256


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _tie_break(df: DataFrame, first: list[str]) -> list[str]:
    """``first`` then every other orderable column: a total, deterministic order."""
    rest = [f.name for f in df.schema.fields
            if f.name not in first and not isinstance(f.dataType, (T.MapType, T.BinaryType))]
    return first + rest


def top_n(df: DataFrame, order: list[Column], n: int, groups: int = GROUPS) -> DataFrame:
    """Global top ``n`` by ``order`` (Columns with direction), two-level."""
    g = df.withColumn("_g", F.spark_partition_id() % F.lit(groups))
    w = Window.partitionBy("_g").orderBy(*order)
    local = (g.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") <= n).drop("_rn", "_g"))
    return local.orderBy(*order).limit(n)


def latest_n(df: DataFrame, keys, order, n: int, rank_col: str | None = None) -> DataFrame:
    """L1: newest ``n`` rows per key by ``order`` (descending; remaining columns
    break ties).  Without keys: the newest ``n`` rows overall."""
    tie = _tie_break(df, _names(order))
    desc = [F.col(c).desc_nulls_last() for c in tie]
    if not keys:
        return top_n(df, desc, n)
    w = Window.partitionBy(*_names(keys)).orderBy(*desc)
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def head(df: DataFrame, n: int, order=None) -> DataFrame:
    """L2: first ``n`` rows; with ``order`` (ascending, remaining columns break
    ties) the choice is deterministic."""
    if order is None:
        return df.limit(n)
    asc = [F.col(c).asc_nulls_first() for c in _tie_break(df, _names(order))]
    return top_n(df, asc, n)
