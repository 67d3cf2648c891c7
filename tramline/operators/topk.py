"""Newest rows, top rows and top rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.clock import AsOf, recent


def newest(df: DataFrame, n: int, time: str = "timestamp", tie: str = "id") -> DataFrame:
    """The ``n`` newest rows; every task keeps only its own ``n`` before they are merged."""
    return df.orderBy(F.desc(time), F.col(tie)).limit(n)


def newest_per_group(df: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of each group; Spark cuts groups to ``n`` before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("place", place).where(F.col("place") <= n).drop("place")


def recent_predictions(predictions: DataFrame, limit: int = 100) -> DataFrame:
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(c)
    columns = ["id", "trip_id", "route_id", "stop_id", "arrival_time", "delay", "timestamp"]
    return newest(predictions.select(*columns), limit).select(
        "id", "trip_id", "route_id", "stop_id", iso("arrival_time"), "delay", iso("timestamp"))


def recent_alerts(
    alerts: DataFrame, limit: int = 20, as_of: AsOf = None, hours: float | None = None,
) -> DataFrame:
    """The newest alerts, of the window if one is given."""
    return newest(recent(alerts, as_of, hours), limit, tie="alert_id")


def kpi_points(snapshots: DataFrame, n: int = 24) -> DataFrame:
    """The last ``n`` snapshots of each kind."""
    return newest_per_group(snapshots, ["kind"], n, F.desc("as_of"))
