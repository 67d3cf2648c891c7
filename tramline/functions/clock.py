"""The explicit clock: every time-relative operator takes ``as_of``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = dt.datetime | Column | None


def as_of_column(as_of: AsOf) -> Column:
    """``as_of`` as a timestamp; the current time when none is given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def ago(as_of: AsOf, hours: float) -> Column:
    """``as_of`` minus an exact number of hours (fractions allowed)."""
    return as_of_column(as_of) - F.lit(dt.timedelta(hours=hours))


def recent(df: DataFrame, as_of: AsOf, hours: float | None, column: str = "timestamp") -> DataFrame:
    """Rows at or after ``as_of - hours``; no upper bound. ``None`` keeps all.

    The bound is a folded literal, so it reaches the Parquet scan. Tables laid
    out by ``partition_date`` also get the date bound that prunes folders.
    """
    if hours is None:
        return df
    since = ago(as_of, hours)
    kept = df.where(F.col(column) >= since)
    if "partition_date" in df.columns and column == "timestamp":
        kept = kept.where(F.col("partition_date") >= F.date_format(since, "yyyy-MM-dd"))
    return kept


def hour_spine(df: DataFrame, as_of: AsOf, hours: float) -> DataFrame:
    """One row per hour from the hour of ``as_of - hours`` to that of ``as_of``, inclusive."""
    return df.sparkSession.range(1, numPartitions=1).select(
        F.explode(F.sequence(
            F.date_trunc("hour", ago(as_of, hours)),
            F.date_trunc("hour", as_of_column(as_of)),
            F.lit(dt.timedelta(hours=1)),
        )).alias("hour_bucket"))


def up_to_hour(df: DataFrame, as_of: AsOf, column: str = "timestamp") -> DataFrame:
    """Rows up to the end of the hour of ``as_of``, the last hour of a spine."""
    end = F.date_trunc("hour", as_of_column(as_of)) + F.lit(dt.timedelta(hours=1))
    return df.where(F.col(column) < end)


def on_spine(hourly: DataFrame, as_of: AsOf, hours: float) -> DataFrame:
    """Gap fill: every spine hour, with the hourly aggregate where there is one.

    Hours beyond the spine are cut first, which leaves the aggregate at most one
    row per spine hour.
    """
    inside = hourly.where(F.col("hour_bucket") <= F.date_trunc("hour", as_of_column(as_of)))
    return hour_spine(hourly, as_of, hours).join(inside, "hour_bucket", "left")
