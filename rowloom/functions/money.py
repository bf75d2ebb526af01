"""Exact money arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums keep Spark's own width for sums of DECIMAL(18,2), so large tables do not overflow.
SUM_TYPE = "decimal(28,2)"
MONEY_TYPE = "decimal(18,2)"


def total(col: Column) -> Column:
    return F.sum(col).cast(SUM_TYPE)


def mean(total_col: Column, count_col: Column) -> Column:
    """Average as a double from an exact sum and a count; NULL for no values."""
    return F.try_divide(total_col.cast("double"), count_col.cast("double"))


def rounded_ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """``numerator / denominator`` rounded half up to hundredths, without binary fractions.

    ``numerator`` is a decimal with at most ``scale`` digits after the point; the division
    is done on whole numbers: (2s + n) div 2n hundredths, mirrored below zero.  A zero
    denominator gives NULL.
    """
    n = F.nullif(denominator.cast("bigint"), F.lit(0).cast("bigint"))
    factor = F.lit(10**scale)
    units = (F.abs(numerator) * factor).cast("decimal(36,0)")
    below = 10 ** (scale - 2)  # numerator units per hundredth
    twice = (n * F.lit(2 * below)).cast("decimal(20,0)")
    hundredths = F.call_function("div", units * F.lit(2) + n * F.lit(below), twice)
    signed = F.when(numerator < 0, -hundredths).otherwise(hundredths)
    return (signed.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY_TYPE)
