"""Column helpers shared by the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Runs of characters other than blanks.
WORD = r"[^ \x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def crc32_of(column: str) -> Column:
    """crc32 of a column as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and all others in one struct, so that no name of
    theirs meets one that an operator adds."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    return docs.select(*needed, F.struct(F.lit(0).alias("_"), *others).alias("_others"))


def unpacked(rows: DataFrame, columns: list[str], *needed: str) -> DataFrame:
    """The original columns again."""
    return rows.select(*(F.col(c) if c in needed else F.col("_others")[c].alias(c) for c in columns))
