"""Topics, KPI snapshots and JSON exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.clock import AsOf, as_of_column
from tramline.operators.shape import stack

TIME_FORMAT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}

# Topic and key columns per record type; the first key that is given is used.
TOPICS = {
    "prediction": ("transit.predictions.raw", ["trip_id", "prediction_id"]),
    "vehicle_position": ("transit.vehicles.raw", ["vehicle_id"]),
    "alert": ("transit.alerts.raw", ["alert_id"]),
    "trip_update": ("transit.trip_updates.raw", ["trip_id"]),
}


def as_json(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns), TIME_FORMAT)


def messages(df: DataFrame, kind: str) -> DataFrame:
    """Records as keyed topic messages with their route; types without a topic give no rows.

    Topic, key and route come from the record itself, so the text of a message
    is only made where it is written.
    """
    if kind not in TOPICS:
        names = ("topic", "key", "route_id", "value")
        return df.select(*[F.lit(None).cast("string").alias(c) for c in names]).where(F.lit(False))
    topic, keys = TOPICS[kind]
    return df.select(
        F.lit(topic).alias("topic"), F.coalesce(*[F.col(k) for k in keys]).alias("key"),
        (F.col("route_id") if "route_id" in df.columns else F.lit(None).cast("string")).alias("route_id"),
        as_json("*").alias("value"))


def route_messages(frames: dict[str, DataFrame]) -> DataFrame:
    return stack(*[messages(df, kind) for kind, df in frames.items()])


def write_messages(rows: DataFrame, path: str | None = None, servers: str | None = None) -> None:
    """To Kafka where servers are given, else to one folder per topic."""
    rows = rows.select("topic", "key", "value")
    if servers:
        rows.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    else:
        rows.write.mode("append").partitionBy("topic").json(path)


def snapshot(summary: DataFrame, kind: str, as_of: AsOf = None) -> DataFrame:
    """A one-row summary as a row of the snapshot table."""
    return summary.select(
        F.lit(kind).alias("kind"), as_of_column(as_of).alias("as_of"), as_json("*").alias("payload"))


def append_snapshot(summary: DataFrame, kind: str, root: str, as_of: AsOf = None) -> None:
    snapshot(summary, kind, as_of).write.mode("append").partitionBy("kind").parquet(f"{root}/kpi_snapshot")


def export(summary: DataFrame, path: str, format: str = "json") -> None:
    """Write a summary as JSON; no other format is known."""
    if format.lower() != "json":
        raise ValueError(f"unsupported export format: {format}")
    summary.write.mode("overwrite").options(**TIME_FORMAT).json(path)


def publish_stats(documents: dict[str, DataFrame], path: str) -> None:
    """Each part of the published statistics in a folder of its own."""
    for name, frame in documents.items():
        export(frame, f"{path}/{name}")
