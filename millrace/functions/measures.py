"""Numeric expressions of the marts and the profiler."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL for a zero or missing denominator."""
    return F.try_divide(numerator, denominator)


def share_pct(part: Column, whole: Column, kind: str = "decimal(6,3)") -> Column:
    """Share in percent, the part taken as a four-digit decimal of any count."""
    return (ratio(part.cast("decimal(24,4)"), whole.cast("decimal(20,0)")) * 100).cast(kind)


def mean_decimal(total: Column, count: Column, kind: str = "decimal(6,3)") -> Column:
    """Average from a sum and a count, as an exact decimal."""
    return ratio(total.cast("decimal(20,0)"), count.cast("decimal(20,0)")).cast(kind)


def percent_of(part: Column, whole: Column) -> Column:
    """Percentage with two digits; NULL when the whole is zero."""
    return F.round(
        ratio(part.cast("decimal(20,0)"), whole.cast("decimal(20,0)")) * 100, 2
    ).cast("decimal(20,2)")
