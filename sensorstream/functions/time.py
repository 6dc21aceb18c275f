"""Time parsing and formatting as built-in column expressions.

Every parse is a ``try_*`` form: Spark 4 runs with ANSI on, where a plain
``to_timestamp`` raises on the first bad string of a whole job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ISO_TS_FORMAT, SQL_TS_FORMAT

_ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?$"
_SQL_TS_MICRO = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_sql_ts(col) -> Column:
    """Strict ``yyyy-MM-dd HH:mm:ss.SSS``; the ISO ``T`` form gives NULL."""
    return F.try_to_timestamp(_c(col), F.lit(SQL_TS_FORMAT))


def parse_iso_ts(col) -> Column:
    """ISO-8601 date and time with optional fraction and zone (``Z`` = UTC).

    A time alone or a shorter date is NULL: Spark would read the first as
    today's and fill in the second.
    """
    c = _c(col)
    return F.when(c.rlike(_ISO_SHAPE), F.try_to_timestamp(c))


def parse_any_ts(col) -> Column:
    """SQL form with 1-6 fraction digits first, then ISO-8601."""
    c = _c(col)
    return F.coalesce(F.try_to_timestamp(c, F.lit(_SQL_TS_MICRO)), parse_iso_ts(c))


def parse_ts(col, mode: str = "sql") -> Column:
    return {"sql": parse_sql_ts, "iso": parse_iso_ts, "any": parse_any_ts}[mode](col)


def to_epoch_ms(col) -> Column:
    return F.unix_millis(_c(col))


def from_epoch_ms(col) -> Column:
    return F.timestamp_millis(_c(col))


def format_ts(col, style: str = "sql_ms") -> Column:
    """Time to text; ``sql_ms`` truncates (does not round) to milliseconds."""
    fmt = {"sql_ms": SQL_TS_FORMAT, "iso": ISO_TS_FORMAT}.get(style, style)
    return F.date_format(_c(col), fmt)


def to_ntz(col) -> Column:
    """UTC instant as a zone-less timestamp (the column type of the tables)."""
    return _c(col).cast("timestamp_ntz")
