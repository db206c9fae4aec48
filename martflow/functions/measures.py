"""Money and growth expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martflow.schemas import RAW_PRICE


def exact_revenue(quantity: Column, raw_price: Column) -> Column:
    """Quantity x unrounded price, exact in DECIMAL."""
    return quantity.cast("decimal(10,0)") * raw_price.cast(RAW_PRICE)


def revenue(quantity: Column, raw_price: Column, precision: int = 12) -> Column:
    """Quantity x unrounded price, rounded half-up to cents (77.505 -> 77.51);
    NULL when it does not fit the precision, so one such row cannot fail a
    batch."""
    return exact_revenue(quantity, raw_price).try_cast(f"decimal({precision},2)")


def pct_change(current: Column, previous: Column, scale: int = 2) -> Column:
    """ROUND((current - previous) / previous * 100, scale) as DOUBLE.

    NULL when there is no previous value or it is zero (no ANSI error).  The
    quotient is taken in DOUBLE and rounded half away from zero through a
    DECIMAL(38,10), which makes the result independent of how an engine
    rounds binary doubles.
    """
    cur = current.cast("double")
    prev = previous.cast("double")
    ratio = F.try_divide(cur - prev, prev) * F.lit(100.0)
    return F.round(ratio.cast("decimal(38,10)"), scale).cast("double")
