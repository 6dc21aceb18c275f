"""Decode, validate, project and coerce.

The reference parses each message in a Python function and drops it on any
exception.  Here a message becomes typed columns plus one ``reject_reason``
column, computed by built-in expressions only; ``split_valid`` then gives the
valid rows and the rejects (with the reason) as two filters over the same
frame.  Nothing runs per row in Python.

Reject reasons, first match wins:
  ``malformed_json``    not a JSON object, or an empty/``null`` message
  ``missing_<field>``   a required field is absent or ``null``
  ``bad_<field>``       a field's text does not convert to its type
  ``bad_time``          the time text does not parse
  ``null_time``         no event time at all (see ``require_event_time``)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import CORRUPT, from_json_col
from ..functions.time import parse_ts
from ..schemas import READING_WIRE

REASON = "reject_reason"
ENVELOPE_META = ("topic", "partition", "offset")


def decode_json(df: DataFrame, schema: T.StructType = READING_WIRE, value_col: str = "value",
                keep: tuple[str, ...] = ENVELOPE_META, raw_col: str = "raw") -> DataFrame:
    """JSON text (or UTF-8 bytes) in ``value_col`` -> one column per field.

    Keeps the envelope columns in ``keep`` (those present), the message text as
    ``raw`` and a ``malformed`` flag.  The parse is permissive: it never fails
    a job.
    """
    raw = F.col(value_col).cast("string")
    kept = [c for c in keep if c in df.columns]
    # The bus record time may be kept; it is renamed so that it cannot clash
    # with a payload field of the same name.
    if "timestamp" in kept:
        df = df.withColumnRenamed("timestamp", "record_ts")
        kept = ["record_ts" if c == "timestamp" else c for c in kept]
    # The parse is emitted by a one-row generator.  A later filter on decoded
    # fields (``reject_reason IS NULL``) cannot be pushed below a generator,
    # whereas through a plain projection Catalyst would inline the parse once
    # per field reference (seen: 17 copies of from_json in one plan).
    row = F.struct(*[F.col(c) for c in kept], raw.alias(raw_col), from_json_col(raw, schema).alias("_msg"))
    out = df.select(F.inline(F.array(row)))
    fields = schema.fieldNames()
    all_null = F.lit(True)
    for f in fields:
        all_null = all_null & F.col(f"_msg.{f}").isNull()
    malformed = (F.col(f"_msg.{CORRUPT}").isNotNull() | F.col("_msg").isNull() | all_null)
    return out.select(*kept, raw_col, *[F.col(f"_msg.{f}").alias(f) for f in fields],
                      malformed.alias("malformed"))


def _flag(df: DataFrame, cond: Column, reason: Column | str) -> DataFrame:
    r = F.lit(reason) if isinstance(reason, str) else reason
    if REASON in df.columns:
        return df.withColumn(REASON, F.coalesce(F.col(REASON), F.when(cond, r)))
    return df.withColumn(REASON, F.when(cond, r))


def flag_malformed(df: DataFrame) -> DataFrame:
    out = _flag(df, F.col("malformed"), "malformed_json") if "malformed" in df.columns else df
    return out.drop("malformed")


#: Readings of this size or more are no measurements.
MOST_READING = 1e15
#: Letters with which a cast takes more than a decimal number: ``31.5d``, ``0x1p3``.
_NO_DECIMAL = "dDfFxX"


def require_fields(df: DataFrame, required: list[str]) -> DataFrame:
    """Flag the first required field that is NULL (F1 is the complement)."""
    out = df
    for f in required:
        out = _flag(out, F.col(f).isNull(), f"missing_{f}")
    return out


def coerce(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """``try_cast`` each field; a non-NULL input that does not convert is
    flagged ``bad_<field>``.  A float must be a finite decimal number under
    ``MOST_READING`` without a type letter (``31.5d``): one such reading would
    decide a whole window's mean."""
    out = df
    for name, typ in types.items():
        text = F.col(name).cast("string")
        cast = text.try_cast(typ) if typ != "string" else F.col(name)
        if typ in ("double", "float"):
            cast = F.when((F.abs(cast) < MOST_READING) & ~F.isnan(cast) & (F.translate(text, _NO_DECIMAL, "") == text), cast)
        out = _flag(out, F.col(name).isNotNull() & cast.isNull(), f"bad_{name}")
        out = out.withColumn(name, cast)
    return out


def with_event_time(df: DataFrame, text_col: str = "timestamp", out: str = "ts",
                    mode: str = "sql", flag: bool = True) -> DataFrame:
    """Computed event-time column from the message's time text."""
    ts = parse_ts(text_col, mode)
    o = df.withColumn(out, ts)
    if flag:
        o = _flag(o, F.col(text_col).isNotNull() & F.col(out).isNull(), "bad_time")
    return o


def require_event_time(df: DataFrame, ts: str = "ts", on_null_time: str = "quarantine") -> DataFrame:
    """What to do with a row that has no event time.

    ``quarantine`` flags it (it goes to the rejects), ``drop`` removes it,
    ``fail`` raises at run time.  Must run before any ``window()``, which would
    drop such rows silently.
    """
    # The policy applies to rows that passed every other check; a row already
    # rejected for another reason keeps that reason and goes to the rejects.
    missing = F.col(ts).isNull()
    if REASON in df.columns:
        missing = missing & F.col(REASON).isNull()
    if on_null_time == "drop":
        return df.filter(~missing)
    if on_null_time == "fail":
        return df.withColumn(ts, F.when(missing, F.raise_error(F.lit("row without event time")))
                             .otherwise(F.col(ts)))
    if on_null_time == "quarantine":
        return _flag(df, F.col(ts).isNull(), "null_time")
    raise ValueError(f"unknown on_null_time: {on_null_time}")


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the reason column, rejected rows with it)."""
    if REASON not in df.columns:
        df = df.withColumn(REASON, F.lit(None).cast("string"))
    valid = df.filter(F.col(REASON).isNull()).drop(REASON)
    rejected = df.filter(F.col(REASON).isNotNull())
    return valid, rejected


def project(df: DataFrame, mapping: dict[str, str | Column]) -> DataFrame:
    """``{output: source column or expression}``; nothing else is kept,
    which lets Catalyst prune every other column down to the scan."""
    cols = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()]
    return df.select(*cols)


def with_column(df: DataFrame, name: str, expr: str | Column) -> DataFrame:
    """P5: computed column from SQL text or a Column."""
    return df.withColumn(name, F.expr(expr) if isinstance(expr, str) else expr)


def not_null(df: DataFrame, cols) -> DataFrame:
    """keep rows where every listed column is set."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


READING_FIELDS = ["device_id", "ts", "temperature", "humidity", "status"]


def decode_readings(envelope: DataFrame, required=("device_id", "timestamp", "temperature"),
                    time_mode: str = "sql", on_null_time: str = "quarantine",
                    value_col: str = "value", max_skew: str | None = None,
                    time_source: str = "payload", keep_record: bool = False) -> DataFrame:
    """The whole reading decode as one flagged frame: JSON -> required fields ->
    numbers -> event time.  ``split_valid`` separates the result.

    ``max_skew`` (e.g. ``"1 hour"``) rejects readings stamped further than that
    after their bus record time (``future_time``): one device with a wrong
    clock would otherwise move the global watermark and close every device's
    windows early.

    ``on_null_time``: ``quarantine`` names an absent or unreadable time as a
    reject reason; ``drop`` and ``fail`` act on every row that has no event
    time and passed all other checks.  ``time_source="record"`` takes the bus
    record time as event time (W6); the payload's time is then not needed.
    ``keep_record`` leaves the record time in the result as ``record_ts``.
    """
    if time_source not in ("payload", "record"):
        raise ValueError(f"unknown time source: {time_source}")
    d = decode_json(envelope, READING_WIRE, value_col=value_col, keep=ENVELOPE_META + ("timestamp",))
    d = check_readings(flag_malformed(d), required, time_mode, on_null_time, max_skew, time_source)
    return d if keep_record else d.drop("record_ts")


def check_readings(d: DataFrame, required=("device_id", "timestamp", "temperature"), time_mode: str = "sql",
                   on_null_time: str = "quarantine", max_skew: str | None = None,
                   time_source: str = "payload") -> DataFrame:
    """The checks of ``decode_readings`` on fields that are already decoded."""
    named = on_null_time == "quarantine" and time_source == "payload"
    d = require_fields(d, [f for f in required if named or f != "timestamp"])
    d = coerce(d, {"temperature": "double", "humidity": "double"})
    if time_source == "record":
        d = d.withColumn("ts", F.col("record_ts").cast("timestamp"))
    else:
        d = with_event_time(d, "timestamp", "ts", time_mode, flag=named)
    if not named or "timestamp" not in required:
        d = require_event_time(d, "ts", on_null_time)
    if max_skew:
        late = F.col("ts") > F.col("record_ts") + F.expr(f"INTERVAL {max_skew}")
        d = _flag(d, late, "future_time")
    return d
