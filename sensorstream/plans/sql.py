"""SQL text entry points (Q1).

The reference's jobs are SQL scripts run statement by statement.  Here the
source is declared with ``sources.catalog.declare_stream`` (computed event
time + watermark) and the statements are Spark SQL; the window table function
of other dialects is written as ``GROUP BY key, window(ts, width)``.
"""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.bus import encode_messages, write_bus
from ..sources.catalog import Sink, TopicSink, declared_sink, fit
from ..sources.tables import upsert_table
from ..streaming.runner import start_query
from ..streaming.sinks import bus_sink, upsert_sink

# SQL twin of operators.aggregates.tumbling_avg.
TUMBLING_AVG_SQL = """
SELECT device_id,
       window.start AS window_start,
       window.end   AS window_end,
       {mean} AS avg_temp
FROM {source}
GROUP BY device_id, window({ts}, '{width}')
"""


def tumbling_avg_sql(source: str = "iot_sensor_data", ts: str = "ts", width: str = "1 minute",
                     exact_scale: int | None = None) -> str:
    """``exact_scale``: an order-independent mean of readings with at most so many decimals."""
    mean = "AVG(temperature)" if exact_scale is None else (
        f"CAST(SUM(CAST(temperature AS DECIMAL(28,{exact_scale}))) AS DOUBLE) / COUNT(temperature)")
    return TUMBLING_AVG_SQL.format(source=source, ts=ts, width=width, mean=mean)


def split_statements(script: str) -> list[str]:
    """Split a script at top-level ``;`` (quotes and ``--`` comments respected)."""
    out, cur, quote, comment = [], [], None, False
    for i, ch in enumerate(script):
        if comment:
            if ch == "\n":
                comment = False
                cur.append(ch)
            continue
        if not quote and ch == "-" and script[i + 1:i + 2] == "-":
            comment = True
            continue
        if quote:
            cur.append(ch)
            if ch == quote:
                quote = None
            continue
        if ch in ("'", '"', "`"):
            quote = ch
            cur.append(ch)
        elif ch == ";":
            stmt = "".join(cur).strip()
            if stmt:
                out.append(stmt)
            cur = []
        else:
            cur.append(ch)
    tail = "".join(cur).strip()
    if tail:
        out.append(tail)
    return out


_INSERT = re.compile(r"\s*insert\s+into\s+(?:table\s+)?`?(\w+)`?\s*(?:\(([\w\s,`]+)\)\s*)?(?=\(?\s*(?:select|with)\b)",
                     re.IGNORECASE)


def _insert(df: DataFrame, name: str, sink: Sink | TopicSink, columns: list[str] | None) -> StreamingQuery | DataFrame:
    """Start a stream into a declared sink, or write a batch into it."""
    if isinstance(sink, TopicSink):
        return _insert_into_topic(fit(df, sink.schema, name, columns), name, sink)
    df = df.toDF(*columns) if columns else df
    if df.isStreaming:
        return start_query(df, upsert_sink(sink.path, list(sink.keys)), f"insert_{name}", sink.checkpoint, sink.mode,
                           no_data_batches=(sink.mode != "update"), state_partitions=sink.state_partitions)
    upsert_table(df, sink.path, time.time_ns(), list(sink.keys))
    return df


def _insert_into_topic(rows: DataFrame, name: str, sink: TopicSink) -> StreamingQuery | DataFrame:
    """Rows as JSON messages.  A stream appends: a window's row is written once,
    when the watermark passes its end, so an aggregate needs a watermark."""
    messages = encode_messages(rows, sink.schema.names, sink.topic, sink.ts_format, sink.key_col, sink.time_col)
    if rows.isStreaming:
        writer = bus_sink(messages, sink.path, sink.topic, sink.format, sink.bootstrap)
        return start_query(messages, None, f"insert_{name}", sink.checkpoint, "append", writer=writer,
                           state_partitions=sink.state_partitions)
    write_bus(messages, sink.topic, sink.format, sink.path, sink.bootstrap)
    return rows


def run_sql(spark: SparkSession, statements) -> DataFrame | StreamingQuery | None:
    """Q1: run statements in order; return the last one's result.

    ``INSERT INTO name [(columns)] SELECT ...`` into a sink of
    ``catalog.declare_sink`` or a topic of ``catalog.declare_topic`` starts a
    streaming query where the SELECT reads a stream (the query is the result)
    and writes a batch otherwise.  A topic's columns are filled by position and
    checked; its messages are JSON.  Every other statement, an INSERT into another table too, is Spark's own.  A streaming
    SELECT is returned to be started with ``streaming.runner.start_query``.
    """
    if isinstance(statements, str):
        statements = split_statements(statements)
    last = None
    for stmt in statements:
        found = _INSERT.match(stmt)
        sink = declared_sink(found[1]) if found else None
        columns = [c.strip(" `\n\t") for c in found[2].split(",")] if found and found[2] else None
        last = _insert(spark.sql(stmt[found.end():]), found[1], sink, columns) if sink else spark.sql(stmt)
    return last
