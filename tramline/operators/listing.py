"""Listings of dimensions and alerts for display."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.operators.enrich import display_colour


def route_listing(routes: DataFrame) -> DataFrame:
    own = lambda c: F.col(c) if c in routes.columns else F.lit(None).cast("string")
    return routes.select(
        "id", F.col("route_name").alias("name"), F.col("route_type").alias("type"),
        own("route_color").alias("color"), own("route_text_color").alias("text_color"))


def stop_listing(stops: DataFrame, predictions: DataFrame | None = None, route_id: str | None = None) -> DataFrame:
    """All stops, or those with predictions of one route."""
    if route_id is not None:
        served = predictions.where(F.col("route_id") == route_id).select(F.col("stop_id").alias("id")).distinct()
        stops = stops.join(served, "id", "left_semi")
    return stops.select(
        "id", F.col("stop_name").alias("name"), F.col("stop_lat").alias("latitude"),
        F.col("stop_lon").alias("longitude"), "wheelchair_boarding")


def alert_listing(alerts: DataFrame) -> DataFrame:
    text = lambda c: F.col(c) if c in alerts.columns else F.lit(None).cast("string")
    return alerts.select(
        F.col("alert_header_text").alias("header"), F.col("alert_severity_level").alias("severity"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm").alias("timestamp"),
        text("alert_description_text").alias("description"))


def stops_in_box(stops: DataFrame, lat: tuple[float, float], lon: tuple[float, float]) -> DataFrame:
    inside = F.col("stop_lat").between(*lat) & F.col("stop_lon").between(*lon)
    return stops.agg(F.count_if(inside).alias("stops"))


def route_colours(used: DataFrame, routes: DataFrame) -> DataFrame:
    """The display colour of every route id in ``used``."""
    known = routes.select(F.col("id").alias("route_id"), "route_color")
    return used.select("route_id").distinct().join(known, "route_id", "left").select(
        "route_id", display_colour(F.col("route_id"), F.col("route_color")).alias("colour"))
