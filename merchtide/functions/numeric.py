"""Rounding, guarded ratios and sums that do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int) -> Column:
    """Round a double half to even on its scaled value."""
    scale = F.lit(10.0**digits)
    return F.rint(value * scale) / scale


def units(value: Column, digits: int = 2) -> Column:
    """A value with a fixed number of decimals as a whole number of its last digit."""
    return F.rint(value.cast("double") * F.lit(10.0**digits)).cast("long")


def fixed_sum(value: Column, digits: int = 2) -> Column:
    """Sum in whole units: the result is the same for every partitioning."""
    return F.sum(units(value, digits)) / F.lit(10.0**digits)


def fixed_avg(value: Column, digits: int = 2) -> Column:
    """Mean of a fixed-decimal value, NULL rows left out, NULL when there are none."""
    total = F.sum(units(value, digits)).cast("double")
    return F.try_divide(total, F.count(value) * F.lit(10.0**digits))


def ratio(top: Column, bottom: Column) -> Column:
    """Double division, NULL where the denominator is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def clamped(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Keep a double inside bounds; a NULL stays NULL."""
    out = value
    if low is not None:
        out = F.when(out < F.lit(low), F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(out > F.lit(high), F.lit(high)).otherwise(out)
    return out
