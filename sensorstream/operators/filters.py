"""Row filters (F2-F4) and topic routing.

Filters are plain ``filter`` expressions on columns, so Catalyst pushes them
into the Parquet scan (``PushedFilters``) and, for keyed-table views, below
the latest-wins aggregate when they only touch key columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_equals(df: DataFrame, col: str, value) -> DataFrame:
    """``WHERE col = value``."""
    return df.filter(F.col(col) == F.lit(value))


def time_range(df: DataFrame, ts: str, start=None, end=None, partition: str | None = None,
               of: Callable[[Column], Column] = F.to_date) -> DataFrame:
    """``start <= ts < end`` (either bound optional).

    ``partition`` names a column that is ``of(ts)`` in every row, a function that
    never falls as time goes on (default: the day).  The range then bounds it
    too, which prunes the folders of a table partitioned by it; Catalyst does
    not know how the two columns hang together."""
    cond = F.lit(True)
    for bound, above in ((start, True), (end, False)):
        if bound is None:
            continue
        at = F.lit(bound).cast("timestamp")
        cond = cond & (F.col(ts) >= at if above else F.col(ts) < at)
        if partition is not None:
            cond = cond & (F.col(partition) >= of(at) if above else F.col(partition) <= of(at))
    return df.filter(cond)


def label(name: str, labels_col: str = "labels") -> Column:
    """Value of one label; a missing label reads as ``''``."""
    return F.coalesce(F.col(labels_col).getItem(name), F.lit(""))


def match_labels(df: DataFrame, eq: dict | None = None, ne: dict | None = None,
                 re: dict | None = None, nre: dict | None = None,
                 labels_col: str = "labels") -> DataFrame:
    """label selector ``{k="v", k!="v", k=~"re", k!~"re"}`` on a MAP column.
    Regular expressions match the whole value."""
    cond = F.lit(True)
    for k, v in (eq or {}).items():
        cond = cond & (label(k, labels_col) == F.lit(v))
    for k, v in (ne or {}).items():
        cond = cond & (label(k, labels_col) != F.lit(v))
    for k, v in (re or {}).items():
        cond = cond & label(k, labels_col).rlike(f"^(?:{v})$")
    for k, v in (nre or {}).items():
        cond = cond & ~label(k, labels_col).rlike(f"^(?:{v})$")
    return df.filter(cond)


def with_labels(df: DataFrame, names: list[str], labels_col: str = "labels") -> DataFrame:
    """Flatten labels into string columns (missing -> ``''``) for grouping."""
    return df.select("*", *[label(n, labels_col).alias(n) for n in names])


UNROUTED = "rejected"


def route(df: DataFrame, routes: dict[str, str], topic_col: str = "topic",
          on_unknown: str = "reject", out: str = "route") -> DataFrame:
    """Tag each record with the handler for its topic.

    ``routes`` maps topic -> handler name.  Unknown topics are tagged
    ``rejected`` (``on_unknown="reject"``) or removed (``"drop"``).  Branches
    are then separate filters over the same (persisted) frame, see
    ``split_routes`` and ``streaming.sinks.route_batch``.
    """
    tag = F.lit(None).cast("string")
    for topic, handler in reversed(list(routes.items())):
        tag = F.when(F.col(topic_col) == F.lit(topic), F.lit(handler)).otherwise(tag)
    tagged = df.withColumn(out, tag)
    if on_unknown == "drop":
        return tagged.filter(F.col(out).isNotNull())
    if on_unknown == "reject":
        return tagged.withColumn(out, F.coalesce(F.col(out), F.lit(UNROUTED)))
    raise ValueError(f"unknown on_unknown: {on_unknown}")


def split_routes(tagged: DataFrame, names, out: str = "route") -> dict[str, DataFrame]:
    return {n: tagged.filter(F.col(out) == F.lit(n)).drop(out) for n in names}
