"""A summary that is kept up with each batch instead of being worked out anew.

Every batch of predictions adds its counters per hour and route to a table of
parts. Counters add up, so the summary at any time is the sum of the parts, and
its size follows hours and routes, not predictions. Parts appear under the plan
of their batch (``sinks.commits``): a batch that is taken again adds nothing, and
half a batch is never summed. ``sinks.store.compact_day`` keeps files few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tramline.functions.clock import AsOf, as_of_column
from tramline.functions.measures import SEVERE_SECONDS, is_late, lateness, percent, r2, ratio, row_count, sample_stddev
from tramline.sinks.store import append_once
from tramline.sources.tables import read_table

TABLE = "delay_summary"
_COUNTERS = ("n", "late", "severe", "late_s", "late_squares", "delay_s", "known")


def partials(predictions: DataFrame) -> DataFrame:
    """Counters per hour and route; a day folder per day of the hours."""
    delay, late = F.col("delay"), lateness(F.col("delay"))
    return predictions.groupBy(F.date_trunc("hour", "timestamp").alias("hour_bucket"), "route_id").agg(
        row_count().alias("n"), F.count_if(is_late(delay)).alias("late"), F.count_if(delay > SEVERE_SECONDS).alias("severe"),
        F.sum(late.cast("bigint")).alias("late_s"),
        F.sum(late.cast("decimal(19,0)") * late.cast("decimal(18,0)")).cast("decimal(38,0)").alias("late_squares"),
        F.sum(delay.cast("bigint")).alias("delay_s"), F.count(delay).alias("known"), F.max(delay).alias("worst")) \
        .withColumn("partition_date", F.date_format("hour_bucket", "yyyy-MM-dd"))


def add_batch(predictions: DataFrame, root: str, batch_id: str) -> int:
    """The counters of a batch into the table of parts, once; returns how many rows there were."""
    return append_once(partials(predictions).withColumn("batch_id", F.lit(batch_id)), root, TABLE, batch_id)


def start_summary(predictions: DataFrame, root: str, checkpoint: str, name: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the summary of a stream of predictions up; a batch's id holds the stream's name and the query's id."""
    def each(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        add_batch(batch, root, f"{name}-{query}-{number}")

    return predictions.writeStream.queryName(name).foreachBatch(each).option("checkpointLocation", checkpoint) \
        .trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def kept_performance(spark: SparkSession, root: str, routes: DataFrame, as_of: AsOf = None, hours: float = 24) -> DataFrame:
    """``analytics.performance`` from the parts; the window is cut at whole hours."""
    since = F.date_trunc("hour", as_of_column(as_of) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(hours * 3600.0)))
    n = F.col("n")
    sums = read_table(spark, root, TABLE).where(F.col("hour_bucket") >= since).groupBy("route_id").agg(
        *(F.sum(c).alias(c) for c in _COUNTERS))
    return sums.join(routes.select(F.col("id").alias("route_id"), "route_name"), "route_id").select(
        "route_id", "route_name", n.alias("total_predictions"), F.col("late").alias("delayed_predictions"),
        F.col("severe").alias("severely_delayed"), r2(percent(n - F.col("late"), n)).alias("on_time_percentage"),
        r2(ratio(F.col("late_s"), n * 60.0)).alias("avg_delay_minutes"),
        r2(sample_stddev(n, F.col("late_s"), F.col("late_squares")) / 60.0).alias("delay_std_dev_minutes"),
        r2(ratio(F.col("delay_s"), F.col("known") * 60.0)).alias("overall_avg_delay_minutes"))
