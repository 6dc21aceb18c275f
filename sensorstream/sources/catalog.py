"""Declared sources and sinks, usable by name from SQL text (see ``plans.sql``).

A source (S5) is a view with a computed event-time column and a watermark.  A
sink is a keyed table, or a topic of JSON messages with a schema of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SQL_TS_FORMAT


def declare_stream(spark: SparkSession, name: str, df: DataFrame, time_col: str = "ts",
                   time_expr: str | Column | None = None, watermark: str | None = None) -> DataFrame:
    """``CREATE TABLE name (..., ts AS <expr>, WATERMARK FOR ts AS ts - delay)``.

    ``time_expr`` (SQL text or Column) computes ``time_col``; ``watermark`` is
    the allowed disorder (e.g. ``"5 seconds"``) and only applies to streams.
    """
    out = df
    if time_expr is not None:
        out = out.withColumn(time_col, F.expr(time_expr) if isinstance(time_expr, str) else time_expr)
    if watermark is not None and out.isStreaming:
        out = out.withWatermark(time_col, watermark)
    out.createOrReplaceTempView(name)
    return out


@dataclass(frozen=True)
class Sink:
    """Where ``INSERT INTO <name>`` goes: a keyed table and a checkpoint."""
    path: str
    keys: tuple[str, ...]
    checkpoint: str
    mode: str = "update"
    state_partitions: int | None = None


@dataclass(frozen=True)
class TopicSink:
    """Where ``INSERT INTO <name>`` goes: a topic whose messages hold the
    columns of ``schema`` as JSON.  ``path`` is the topic's folder (file
    formats), ``bootstrap`` its servers (``kafka``)."""
    topic: str
    schema: T.StructType
    checkpoint: str
    format: str = "parquet"
    path: str | None = None
    bootstrap: str | None = None
    key_col: str | None = None
    time_col: str | None = None
    ts_format: str = SQL_TS_FORMAT
    state_partitions: int | None = None


_SINKS: dict[str, Sink | TopicSink] = {}


def declare_sink(name: str, path: str, keys, checkpoint: str, mode: str = "update",
                 state_partitions: int | None = None) -> Sink:
    """``CREATE TABLE name (..., PRIMARY KEY (keys)) WITH (path)``: a keyed
    table that a script can insert into (see ``plans.sql.run_sql``)."""
    keys = (keys,) if isinstance(keys, str) else tuple(keys)
    _SINKS[name.lower()] = Sink(path, keys, checkpoint, mode, state_partitions)
    return _SINKS[name.lower()]


def declare_topic(name: str, schema: str | T.StructType, checkpoint: str, topic: str | None = None,
                  format: str = "parquet", path: str | None = None, bootstrap: str | None = None,
                  key_col: str | None = None, time_col: str | None = None,
                  state_partitions: int | None = None) -> TopicSink:
    """``CREATE TABLE name (schema) WITH (topic, format = json)``: an append-only
    topic that a script can insert into.  ``schema`` is a type or DDL text;
    ``topic`` is ``name`` unless given.  ``key_col`` and ``time_col`` name the
    columns that become a message's key and record time (default: none, and the
    time of writing)."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if (bootstrap if format == "kafka" else path) is None:
        raise ValueError(f"topic {name}: format {format!r} needs {'bootstrap' if format == 'kafka' else 'a path'}")
    for c in (key_col, time_col):
        if c is not None and c not in schema.names:
            raise ValueError(f"topic {name}: no column {c}")
    _SINKS[name.lower()] = TopicSink(topic or name, schema, checkpoint, format, path, bootstrap, key_col, time_col,
                                     state_partitions=state_partitions)
    return _SINKS[name.lower()]


def declared_sink(name: str) -> Sink | TopicSink | None:
    return _SINKS.get(name.lower())


def _assignable(have: T.DataType, want: T.DataType) -> bool:
    """May a value be stored without being reinterpreted?  Text is never
    parsed; numbers fit numbers (out of range raises); times fit times."""
    times = (T.TimestampType, T.TimestampNTZType, T.DateType)
    if have == want or isinstance(have, T.NullType):
        return True
    if isinstance(want, T.StringType):
        return isinstance(have, T.AtomicType) and not isinstance(have, T.BinaryType)
    return ((isinstance(have, T.NumericType) and isinstance(want, T.NumericType))
            or (isinstance(have, times) and isinstance(want, times)))


def fit(df: DataFrame, schema: T.StructType, name: str, columns: list[str] | None = None) -> DataFrame:
    """``df``'s columns as those of ``schema``, by position (or as ``columns``
    name them; those left out are null).  A wrong number, an unknown or
    repeated name and a type that does not fit raise ``ValueError``; a null in a
    column that allows none fails the query."""
    known = {f.name.lower(): f for f in schema.fields}
    names = [c.lower() for c in columns] if columns is not None else list(known)
    unknown = [c for c in names if c not in known]
    if unknown or len(set(names)) < len(names):
        raise ValueError(f"INSERT INTO {name}: unknown or repeated columns in {names}")
    if len(names) != len(df.columns):
        raise ValueError(f"INSERT INTO {name}: {len(df.columns)} columns for {len(names)}: {', '.join(names)}")
    # Positions, not names: a SELECT may repeat a name or leave one out.
    given = df.toDF(*(f"c{i}" for i in range(len(names))))
    wrong = [f"{c}: {f.dataType.simpleString()} into {known[c].dataType.simpleString()}"
             for c, f in zip(names, given.schema.fields, strict=True) if not _assignable(f.dataType, known[c].dataType)]
    if wrong:
        raise ValueError(f"INSERT INTO {name}: types don't fit: {'; '.join(wrong)}")
    at = {c: F.col(f"c{i}") for i, c in enumerate(names)}

    def value(f: T.StructField) -> Column:
        c = at.get(f.name.lower(), F.lit(None)).cast(f.dataType)
        if not f.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"INSERT INTO {name}: null in {f.name}")).cast(f.dataType)).otherwise(c)
        return c.alias(f.name)
    return given.select(*map(value, schema.fields))
