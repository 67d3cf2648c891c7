"""Feed freshness, ingestion health and request rates from the ingestion log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.clock import AsOf, as_of_column
from tramline.functions.measures import row_count
from tramline.operators.shape import fold, stack

MINUTE_MICROS = 60_000_000


def feed_freshness(
    frames: dict[str, DataFrame], as_of: AsOf = None, time: str = "timestamp", max_age_minutes: float = 15,
) -> DataFrame:
    """Age of the newest record per feed, with the feed tier and the page tier."""
    rows = stack(*[df.select(F.lit(n).alias("feed"), F.col(time).alias("seen")) for n, df in frames.items()])
    clock = as_of_column(as_of)
    age = (F.unix_micros(clock) - F.unix_micros("last_update")) / 1_000_000.0
    a = F.col("age_seconds")
    return (
        rows.groupBy("feed").agg(F.max("seen").alias("last_update"))
        .withColumn("age_seconds", age)
        .select(
            "feed", "last_update", "age_seconds",
            F.when(a < 300, "fresh").when(a < 900, "stale").otherwise("old").alias("status"),
            (a <= max_age_minutes * 60).alias("is_fresh"),
            F.when(a < 300, "live").when(a < 1800, "may be stale").otherwise("stale").alias("data_tier")))


def ingestion_health(log: DataFrame, degraded_from: int = 5) -> DataFrame:
    """Per source: totals, errors, and how many failures in a row end the log."""
    failed = F.col("status") == "error"
    per_source = log.groupBy("source_type").agg(
        F.sum("records_processed").alias("records_processed"),
        F.sum("records_inserted").alias("records_inserted"),
        F.sum("records_failed").alias("records_failed"),
        F.count_if(failed).alias("total_errors"),
        row_count().alias("runs"),
        F.max(F.when(~failed, F.col("completed_at"))).alias("last_success"))
    # Only failures can be in the closing run, and only those after the last success.
    closing = (
        log.where(failed).select("source_type", "completed_at")
        .join(per_source.select("source_type", "last_success"), "source_type")
        .where("last_success IS NULL OR completed_at > last_success")
        .groupBy("source_type").agg(row_count().alias("consecutive_failures")))
    run = F.coalesce(F.col("consecutive_failures"), F.lit(0))
    return per_source.join(closing, "source_type", "left").select(
        "source_type", "runs", "records_processed", "records_inserted", "records_failed",
        "total_errors", "last_success", run.alias("consecutive_failures"),
        F.when(run < degraded_from, "healthy").otherwise("degraded").alias("status"))


def trailing_minute_requests(log: DataFrame) -> DataFrame:
    """Per source and request time, the requests of the minute that ends there.

    Equal times collapse first. Every time then lands in the slot of its own
    minute and in the next one, so a window never spans more than two minutes of
    clock, however many requests a source makes.
    """
    micros = F.unix_micros("started_at")
    counted = log.groupBy("source_type", "started_at").agg(row_count().alias("requests"))
    own = F.floor(micros / MINUTE_MICROS)
    slotted = counted.withColumn("micros", micros).withColumn(
        "slot", F.explode(F.array(own, own + 1)))
    trailing = (
        Window.partitionBy("source_type", "slot").orderBy("micros")
        .rangeBetween(-(MINUTE_MICROS - 1), 0))
    return (
        slotted.withColumn("in_last_minute", F.sum("requests").over(trailing))
        .where(F.col("slot") == own)
        .select("source_type", "started_at", "requests", "in_last_minute"))


def pipeline_health(
    log: DataFrame, service_health: DataFrame, types: DataFrame, performance: DataFrame,
    as_of: AsOf = None,
) -> DataFrame:
    """One row with the state of ingestion, the record totals and the latest measures."""
    sources = ingestion_health(log).agg(
        row_count().alias("sources"),
        F.count_if(F.col("status") == "degraded").alias("degraded_sources"),
        F.sum("records_processed").alias("records_processed"))
    return fold(
        sources,
        service_health.select("service_status", "delay_percentage", "total_alerts"),
        types.agg(F.sum("count").alias("total_records"), F.max("last_seen").alias("last_record")),
        performance.select("on_time_percentage", "total_trips"),
    ).select(
        "*", as_of_column(as_of).alias("timestamp"),
        F.when(F.col("degraded_sources") > 0, "degraded").otherwise("healthy").alias("status"))
