"""Delay measures and the rounding rule used by every report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEVERE_SECONDS = 300


def r2(value: Column) -> Column:
    """Two decimals, halves away from zero, computed the same way everywhere."""
    scaled = F.when(value < 0, -F.floor(0.5 - value * 100.0)).otherwise(F.floor(value * 100.0 + 0.5))
    return scaled / F.lit(100.0)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; null when ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part * 100.0, whole)


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def lateness(delay: Column) -> Column:
    """Seconds late: early, punctual and unknown all count as 0."""
    return F.when(delay > 0, delay).otherwise(0)


def row_count() -> Column:
    return F.count(F.lit(1))


def is_late(delay: Column) -> Column:
    return delay > 0


def exact_speed() -> Column:
    """Speed as a decimal, so that a sum does not depend on the order of the rows."""
    return F.col("speed").cast("decimal(18,6)")


def mean_speed(total: Column, n: Column) -> Column:
    return F.round(F.try_divide(total, n.cast("decimal(19,0)")), 2).cast("double")


def sample_stddev(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from whole-number moments; null below two rows.

    The moments are widened to decimals first: the products outgrow 64 bits
    long before the row counts do.
    """
    n_, s_, q_ = (c.cast("decimal(38,0)") for c in (n, total, squares))
    return F.sqrt(ratio(n_ * q_ - s_ * s_, F.when(n > 1, n.cast("double") * (n.cast("double") - 1.0))))
