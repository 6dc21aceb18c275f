"""JSON boundary (P1, P7): text <-> typed columns, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SQL_TS_FORMAT

CORRUPT = "_corrupt_record"


def with_corrupt_field(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def from_json_col(col, schema: T.StructType) -> Column:
    """Permissive parse; a record that is not an object of ``schema`` keeps its
    text in ``_corrupt_record``.  Note: ``''``, ``null`` and objects missing a
    field give NULL fields *without* a corrupt record; callers check required
    fields themselves (see ``operators.decode.split_valid``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c.cast("string"), with_corrupt_field(schema),
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def to_json_col(cols: list[str], ts_format: str = SQL_TS_FORMAT, keep_nulls: bool = True) -> Column:
    """Row -> JSON message; times as ``ts_format``; null fields kept as ``null``."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]),
                     {"timestampFormat": ts_format,
                      "timestampNTZFormat": ts_format,
                      "ignoreNullFields": "false" if keep_nulls else "true"})
