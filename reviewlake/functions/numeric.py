"""Numeric helpers whose results do not depend on how rows are partitioned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_exact(value: Column, digits: int = 2) -> Column:
    """Half-up rounding done on a decimal, so that ties do not depend on binary fractions."""
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")


def ratio(part: Column, total: Column) -> Column:
    """part / total as double; NULL for an empty total instead of an ANSI error."""
    return F.try_divide(part.cast("double"), total.cast("double"))


def percent(part: Column, total: Column) -> Column:
    return F.try_divide(part.cast("double") * F.lit(100.0), total.cast("double"))


def exact(value: Column, scale: int = 6) -> Column:
    """A double as a decimal, whose sums are the same for every row order.

    Scale 6 suits measured values such as ratings; means of means want 12.
    """
    return value.cast(f"decimal({22 + scale // 2},{scale})")


def mean_exact(value: Column, scale: int = 6) -> Column:
    return ratio(F.sum(exact(value, scale)), F.count(value))


def clamp01(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))
