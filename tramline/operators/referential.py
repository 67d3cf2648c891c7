"""Placeholder rows for keys that facts use and dimensions lack."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.measures import row_count
from tramline.operators.shape import stack


def used_keys(column: str, *facts: DataFrame) -> DataFrame:
    """Distinct non-null values of a key column over several fact frames."""
    return stack(*[f.select(F.col(column).alias("id")) for f in facts if column in f.columns]).where(
        "id IS NOT NULL").distinct()


def _missing(keys: DataFrame, dimension: DataFrame, key: str = "id") -> DataFrame:
    return keys.join(dimension.select(F.col(key).alias("id")), "id", "left_anti")


def missing_routes(routes: DataFrame, *facts: DataFrame) -> DataFrame:
    return _missing(used_keys("route_id", *facts), routes).select(
        "id", F.concat(F.lit("Route "), "id").alias("route_name"), F.lit(0).alias("route_type"))


def missing_stops(stops: DataFrame, *facts: DataFrame) -> DataFrame:
    return _missing(used_keys("stop_id", *facts), stops).select(
        "id", F.concat(F.lit("Stop "), "id").alias("stop_name"))


def missing_trips(trips: DataFrame, *facts: DataFrame) -> DataFrame:
    return _missing(used_keys("trip_id", *facts), trips).select(
        "id", F.lit("unknown").alias("route_id"), F.lit("unknown").alias("service_id"))


def unknown_route(routes: DataFrame) -> DataFrame:
    """The route that placeholder trips refer to, when the dimension lacks it."""
    held = routes.where("id = 'unknown'").agg(row_count().alias("n"))
    return held.where("n = 0").select(
        F.lit("unknown").alias("id"), F.lit("Route unknown").alias("route_name"),
        F.lit(0).alias("route_type"))


def missing_vehicles(vehicles: DataFrame, *facts: DataFrame, seed_missing: bool = True) -> DataFrame:
    """Vehicles seen in facts only, with a label where any fact has one."""
    labelled = stack(*[
        f.select("vehicle_id", (F.col("vehicle_label") if "vehicle_label" in f.columns
                                else F.lit(None).cast("string")).alias("vehicle_label"))
        for f in facts if "vehicle_id" in f.columns])
    if not seed_missing:
        labelled = labelled.where(F.lit(False))
    seen = labelled.where("vehicle_id IS NOT NULL").groupBy("vehicle_id").agg(
        F.min("vehicle_label").alias("vehicle_label"))
    return seen.join(vehicles.select("vehicle_id"), "vehicle_id", "left_anti").select(
        F.col("vehicle_id").alias("id"), "vehicle_id", "vehicle_label")
