"""Last write wins per primary key (the read side of K2).

A keyed store's INSERT replaces the row with the same primary key.  On an
append-only log this becomes: among all versions of a key keep the one with
the greatest ``(order..., all other columns)``; the trailing columns make the
choice deterministic when two versions tie on the order columns (the
reference sends messages without a key, so arrival order between partitions
is undefined).

Two physical strategies, same result:
  ``aggregate``  ``max_by`` per key: partial aggregate before the shuffle,
                 best when keys have many versions (replays, hot keys).
  ``window``     ``row_number() = 1``: partial ``WindowGroupLimit`` before the
                 shuffle, best when keys are nearly unique (raw readings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(df: DataFrame, exclude) -> list[str]:
    """Columns usable as a tie-break (MAP columns are not orderable)."""
    return [f.name for f in df.schema.fields
            if f.name not in exclude and not isinstance(f.dataType, T.MapType)]


def latest_wins(df: DataFrame, keys, order, strategy: str = "aggregate") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order or [])
    payload = [c for c in df.columns if c not in keys]
    tie = order + [c for c in _orderable(df, set(keys) | set(order))]
    if strategy == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in tie])
        return (df.withColumn("_rn", F.row_number().over(w))
                  .filter(F.col("_rn") == 1).drop("_rn"))
    if strategy != "aggregate":
        raise ValueError(f"unknown strategy: {strategy}")
    rank = F.struct(*[F.col(c) for c in tie])
    best = F.max_by(F.struct(*[F.col(c) for c in payload]), rank).alias("_v")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in payload]) \
             .select(*df.columns)
