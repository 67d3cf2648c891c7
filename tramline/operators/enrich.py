"""Derived columns per record type, and links from facts to their dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.clock import AsOf, as_of_column
from tramline.functions.codes import lookup
from tramline.schemas import STOP_EVENT_DDL

# Names given to routes, stops and times of travel.
ROUTE_CATEGORY = {0: "Light Rail", 1: "Subway", 2: "Commuter Rail", 3: "Bus", 4: "Ferry"}
SUBWAY_ROUTES = ("Red", "Blue", "Orange")
TIMEZONE = "America/New_York"
# Line names with their display colours, and the colour of anything else.
LINE_COLOURS = {
    "Green": "#00843D", "Red": "#DA291C", "Orange": "#ED8B00", "Blue": "#003DA5",
    "Commuter Rail": "#A020F0", "Bus": "#FFFF00",
}
OTHER_COLOUR = "#95a5a6"


def region_of(lat: Column, lon: Column) -> Column:
    return (
        F.when(lat > 42.4, "North Shore").when(lat < 42.3, "South Shore")
        .when(lon > -71.0, "East Boston").when(lon < -71.1, "West Boston")
        .otherwise("Central Boston"))


def accessibility(code: Column) -> Column:
    return (
        F.when(code.isNull(), F.array(F.lit("unknown")))
        .when(code == 1, F.array(F.lit("wheelchair_accessible")))
        .when(code == 2, F.array(F.lit("wheelchair_inaccessible")))
        .otherwise(F.array().cast("array<string>")))


def route_category(route_type: Column) -> Column:
    return F.coalesce(lookup(route_type, ROUTE_CATEGORY), F.lit("Unknown"))


def service_area(route_id: Column) -> Column:
    return (
        F.when(route_id.startswith("CR-"), "Commuter Rail")
        .when(route_id.startswith("Green-"), "Green Line")
        .when(route_id.isin(*SUBWAY_ROUTES), "Subway")
        .when(route_id.startswith("SL"), "Silver Line")
        .otherwise("Bus"))


def typical_frequency(route_id: Column) -> Column:
    return (
        F.when(route_id.startswith("CR-"), "Peak hours only")
        .when(route_id.isin(*SUBWAY_ROUTES), "Every 3-10 minutes")
        .when(route_id.startswith("Green-"), "Every 5-15 minutes")
        .otherwise("Every 10-30 minutes"))


def direction_name(direction_id: Column) -> Column:
    return F.when(direction_id == 0, "Outbound").otherwise("Inbound")


def prediction_accuracy(delay: Column) -> Column:
    size = F.abs(delay)
    return (
        F.when(delay.isNull(), "unknown").when(size < 60, "high")
        .when(size < 300, "medium").otherwise("low"))


def delay_status(delay: Column) -> Column:
    return (
        F.when(delay.isNull() | (delay <= 0), "on_time").when(delay <= 300, "minor_delay")
        .when(delay <= 900, "moderate_delay").otherwise("major_delay"))


def speed_category(speed: Column) -> Column:
    return (
        F.when(speed.isNull(), "unknown").when(speed < 5, "stopped").when(speed < 15, "slow")
        .when(speed < 30, "normal").otherwise("fast"))


def large_delays(stop_events: Column, over: int = 300) -> Column:
    """How many stop events are off by more than ``over`` seconds, early or late."""
    off = lambda e: F.abs(F.coalesce(e["delay"], e["arrival"]["delay"], e["departure"]["delay"], F.lit(0)))
    return F.size(F.filter(stop_events, lambda e: off(e) > over))


def update_significance(stop_events: Column) -> Column:
    n = large_delays(F.coalesce(stop_events, F.array().cast(f"array<{STOP_EVENT_DDL}>")))
    return F.when(n == 0, "minor").when(n <= 2, "moderate").otherwise("major")


def alert_priority(severity: Column) -> Column:
    return F.when(severity == "SEVERE", "high").when(severity == "WARNING", "medium").otherwise("low")


def affected_services(routes: Column, stops: Column) -> Column:
    """Sorted service areas of the routes, and a note when any stop is named."""
    none = F.array().cast("array<string>")
    areas = F.transform(F.coalesce(routes, none), service_area)
    note = F.when(F.size(stops) > 0, F.array(F.lit("Multiple stops affected"))).otherwise(none)
    named = F.array_sort(F.array_distinct(F.concat(areas, note)))
    return F.when(F.size(named) > 0, named).otherwise(F.array(F.lit("Unknown")))


def display_colour(route_id: Column, own: Column) -> Column:
    by_line = [F.when(route_id.contains(line), colour) for line, colour in LINE_COLOURS.items()]
    return F.coalesce(F.concat(F.lit("#"), own), *by_line, F.lit(OTHER_COLOUR))


def metadata(record_type: str, as_of: AsOf = None) -> Column:
    """The derived fields of a typed record as one struct."""
    c, at = F.col, as_of_column(as_of).alias("enriched_at")
    if record_type == "stop":
        placed = (c("stop_lat") != 0) & (c("stop_lon") != 0)
        return F.when(placed, F.struct(
            F.lit(TIMEZONE).alias("timezone"),
            region_of(c("stop_lat"), c("stop_lon")).alias("geographic_region"),
            accessibility(c("wheelchair_boarding")).alias("accessibility_features"), at))
    fields = {
        "route": lambda: [
            route_category(c("route_type")).alias("route_category"),
            service_area(c("route_id")).alias("service_area"),
            typical_frequency(c("route_id")).alias("typical_frequency")],
        "trip": lambda: [direction_name(c("direction_id")).alias("direction_name")],
        "prediction": lambda: [
            prediction_accuracy(c("delay")).alias("prediction_accuracy"),
            delay_status(c("delay")).alias("service_status")],
        "vehicle_position": lambda: [
            F.lit("good").alias("location_accuracy"),
            speed_category(c("speed")).alias("speed_category"),
            F.when(c("route_id") != "", service_area(c("route_id"))).alias("service_area")],
        "trip_update": lambda: [
            update_significance(c("stop_time_updates")).alias("update_significance"),
            F.coalesce(F.array_size("stop_time_updates"), F.lit(0)).alias("affected_stops_count")],
        "alert": lambda: [
            alert_priority(c("alert_severity_level")).alias("alert_priority"),
            affected_services(c("affected_routes"), c("affected_stops")).alias("affected_services")],
    }
    return F.struct(*fields[record_type](), at)


# Which dimensions each record type is linked to: dimension -> key column of the fact.
LINKS = {
    "trip": {"route": "route_id"},
    "prediction": {"trip": "trip_id", "route": "route_id", "stop": "stop_id"},
    "vehicle_position": {"trip": "trip_id", "route": "route_id"},
    "trip_update": {"trip": "trip_id", "route": "route_id"},
}


def link(facts: DataFrame, record_type: str, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Add each known dimension row as a struct column; unknown keys leave it null.

    ``dimensions`` maps stop, route and trip to typed records with unique ids.
    Left joins without a hint: Spark broadcasts a side only under its size
    threshold and splits hot keys of a shuffled one at run time.
    """
    for name, key in LINKS.get(record_type, {}).items():
        if name in dimensions:
            side = dimensions[name].select(
                F.col(f"{name}_id").alias(key), F.struct("*").alias(f"{name}_info"))
            facts = facts.join(side, key, "left")
    return facts


def enrich(
    df: DataFrame, record_type: str, as_of: AsOf = None,
    dimensions: dict[str, DataFrame] | None = None,
) -> DataFrame:
    out = df.withColumn("metadata", metadata(record_type, as_of))
    return link(out, record_type, dimensions or {})
