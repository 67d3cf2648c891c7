"""Status rules and anomaly checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.clock import AsOf, recent
from tramline.functions.measures import row_count
from tramline.operators.shape import distinct_items, fold


def service_status(delay_percentage: Column, alerts: Column) -> Column:
    return (
        F.when((delay_percentage > 20) | (alerts > 10), "poor")
        .when((delay_percentage > 10) | (alerts > 5), "fair")
        .when((delay_percentage > 5) | (alerts > 2), "good")
        .otherwise("excellent"))


def overall_score(on_time_percentage: Column, high_anomalies: Column, alerts: Column) -> Column:
    return (
        F.lit(100)
        - F.when(on_time_percentage < 80, 20).when(on_time_percentage < 90, 10).otherwise(0)
        - high_anomalies * 15
        - F.when(alerts > 5, 10).otherwise(0))


def overall_status(score: Column) -> Column:
    return (
        F.when(score >= 80, "excellent").when(score >= 60, "good")
        .when(score >= 40, "fair").otherwise("poor"))


def alert_active(as_of: Column, start: str = "active_period_start", end: str = "active_period_end") -> Column:
    """Open ends count as in force; both given ends are inclusive."""
    begun = F.coalesce(F.col(start) <= as_of, F.lit(True))
    unfinished = F.coalesce(F.col(end) >= as_of, F.lit(True))
    return begun & unfinished


def _texts() -> Column:
    return F.array().cast("array<string>")


def delay_anomaly(
    predictions: DataFrame, as_of: AsOf = None, hours: float | None = None, z: float = 3,
) -> DataFrame:
    """One row when delays of the window stand out from all of them, else none.

    The facts are counted per route and whole second; mean and spread, the
    threshold and the extremes come from those counts, in whole numbers.
    """
    counted = recent(predictions, as_of, hours).where("delay IS NOT NULL").groupBy("route_id", "delay").agg(
        row_count().alias("n"))
    n, d = F.col("n").cast("decimal(38,0)"), F.col("delay").cast("decimal(38,0)")
    moments = counted.agg(
        F.sum(n).cast("double").alias("total"), F.sum(n * d).cast("double").alias("sum"),
        (F.sum(n) * F.sum(n * d * d) - F.sum(n * d) * F.sum(n * d)).cast("double").alias("squares"))
    total = F.col("total")
    spread = F.when(total > 1, F.sqrt(F.col("squares") / (total * (total - 1))))
    threshold = moments.select(F.col("sum") / F.nullif(total, F.lit(0.0)) + F.coalesce(spread, F.lit(0.0)) * z)
    return (
        counted.where(F.col("delay") > threshold.scalar())
        .agg(F.sum("n").alias("count"), F.array_sort(F.collect_set("route_id")).alias("affected_routes"))
        .where("count > 0")
        .select(
            F.lit("extreme_delays").alias("anomaly_type"),
            F.when(F.col("count") > 5, "high").otherwise("medium").alias("severity"),
            F.concat(F.lit("Detected "), F.col("count").cast("string"),
                     F.lit(" extreme delays above threshold")).alias("description"),
            "affected_routes",
            _texts().alias("affected_stops"),
            F.lit(0.85).alias("confidence_score")))


def service_disruption(
    alerts: DataFrame, as_of: AsOf = None, hours: float = 1, more_than: int = 10,
) -> DataFrame:
    """One row when there are many recent alerts, else none."""
    window = recent(alerts, as_of, hours)
    parts = fold(
        window.agg(row_count().alias("total")),
        distinct_items(window, "affected_route_ids", "affected_routes"),
        distinct_items(window, "affected_stop_ids", "affected_stops"))
    return parts.where(F.col("total") > more_than).select(
        F.lit("service_disruption").alias("anomaly_type"),
        F.lit("high").alias("severity"),
        F.concat(F.lit("High number of active alerts: "), F.col("total").cast("string")).alias("description"),
        "affected_routes", "affected_stops",
        F.lit(0.90).alias("confidence_score"))


def anomalies(predictions: DataFrame, alerts: DataFrame, as_of: AsOf = None, hours: float = 1) -> DataFrame:
    return delay_anomaly(predictions, as_of, hours).unionByName(service_disruption(alerts, as_of, hours))
