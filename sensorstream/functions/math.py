"""Arithmetic helpers (P6) with ANSI-safe division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_avg(total, n) -> Column:
    """``total / n`` when ``n > 0`` else ``0.0`` (a window with no rows)."""
    t, k = _c(total), _c(n)
    return F.when(k > 0, t.cast("double") / k.cast("double")).otherwise(F.lit(0.0))


def exact_sum(col, scale: int) -> Column:
    """Sum accumulated as a decimal: independent of row order and of how the
    partial aggregates are merged, so a re-run or a re-plan gives identical
    bits.  Only for columns with at most ``scale`` decimals (readings carry
    two by the data contract): the cast rounds anything finer."""
    c = _c(col)
    exact = c.try_cast(f"decimal(28,{scale})")
    # NaN, infinities and values beyond the decimal: the plain sum has them.
    return F.when(F.count(exact) == F.count(c), F.sum(exact).try_cast("double")).otherwise(F.sum(c.cast("double")))


def exact_mean(col, scale: int) -> Column:
    """Order-independent mean of a column with at most ``scale`` decimals;
    NULL when the group has no non-null value (``avg`` semantics)."""
    c = _c(col)
    n = F.count(c)
    return F.when(n > 0, exact_sum(c, scale) / n.cast("double"))


def order_bits(value: Column) -> Column:
    """A double's IEEE bits as a long that orders as Spark orders doubles:
    negative numbers below, then zero, positive ones, infinity, NaN; null stays.

    Built from exact steps only (scaling by powers of two), so two different
    numbers never share a code.  ``0.0`` and ``-0.0`` do, as they are equal.
    """
    x = F.abs(value)
    e = F.least(F.greatest(F.floor(F.log2(x)), F.lit(-1022)), F.lit(1023))
    # The logarithm may round to the wrong side of a power of two: then 2 is the mantissa, or nearly 1.
    m = x / F.pow(F.lit(2.0), e)
    part = (F.when(m >= 2, m / 2).when(m < 1, 2 * m - 2).otherwise(m - 1) * F.lit(2.0 ** 52)).cast("long")
    # Below 2**-1022 there is no leading one; two steps, as 2**1074 is no double.
    tiny = (x * F.lit(2.0 ** 1000) * F.lit(2.0 ** 74)).cast("long")
    plain = (e + 1023) * F.lit(1 << 52) + part
    bits = (F.when(F.isnan(value), F.lit(0x7FF8 << 48)).when(x == F.lit(float("inf")), F.lit(0x7FF0 << 48))
            .when(x < F.lit(2.0 ** -1022), tiny).otherwise(plain))
    return F.when((value < 0) & ~F.isnan(value), -bits).otherwise(bits)


def newest_order(ts: Column, value: Column) -> Column:
    """``(ts, value)`` as one decimal: a fixed-width sort key, with which
    ``max_by`` is a hash aggregate (over a struct it sorts).  A null value comes
    before all others of its time."""
    low = F.coalesce(order_bits(value), F.lit(-(1 << 63)))
    return F.unix_micros(ts).cast("decimal(19,0)") * F.lit(str(1 << 64)).cast("decimal(20,0)") + low.cast("decimal(19,0)")
