"""Validation: every record keeps the names of all the rules it breaks.

A rule is a condition that is null or true for a good record, so an optional
field passes when it is missing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.clock import AsOf, as_of_column
from tramline.functions.measures import percent, r2, row_count

REASONS = "reject_reasons"

# Service area box, limits and code sets.
LAT_BOX, LON_BOX = (42.0, 43.0), (-71.5, -70.5)
MAX_DELAY = 3600
SPEED_RANGE = (0, 50)
BEARING_RANGE = (0, 360)
ACCESS_CODES = (0, 1, 2)
SEVERITIES = ("INFO", "WARNING", "SEVERE")
MAX_AHEAD = dt.timedelta(hours=2)
POSITION_AGE = dt.timedelta(minutes=30)
UPDATE_AGE = dt.timedelta(hours=1)

REQUIRED = {
    "stop": ["stop_id", "stop_name"],
    "route": ["route_id", "route_name", "route_type"],
    "trip": ["trip_id", "route_id"],
    "prediction": ["prediction_id", "trip_id", "stop_id", "route_id"],
    "vehicle_position": ["vehicle_id", "latitude", "longitude", "timestamp"],
    "trip_update": ["trip_id", "timestamp"],
    "alert": ["alert_id"],
}


def present(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return column.isNotNull() & column.rlike(r"(?U)\S")
    return column.isNotNull()


def within(value: Column, bounds: tuple[float, float]) -> Column:
    return value.between(*bounds)


def hex_colour(value: Column) -> Column:
    return (value == "") | value.rlike("^#*[0-9A-Fa-f]{6}$")


def soon(time: Column, now: Column, ahead: dt.timedelta) -> Column:
    """After ``now`` and no more than ``ahead`` later."""
    return (time > now) & (time <= now + F.lit(ahead))


def young(time: Column, now: Column, age: dt.timedelta) -> Column:
    """Not older than ``age``; the future is young."""
    return time >= now - F.lit(age)


def _in_box(lat: str, lon: str) -> Column:
    inside = within(F.col(lat), LAT_BOX) & within(F.col(lon), LON_BOX)
    return F.col(lat).isNull() | F.col(lon).isNull() | inside


def rules(
    df: DataFrame, record_type: str, as_of: AsOf = None,
    severities: tuple[str, ...] = SEVERITIES, alert_age: dt.timedelta | None = None,
) -> dict[str, Column]:
    c, now = F.col, as_of_column(as_of)
    found = {f"missing_{name}": present(df, name) for name in REQUIRED[record_type]}
    specific = {
        "stop": lambda: {
            "outside_area": _in_box("stop_lat", "stop_lon"),
            "bad_wheelchair_boarding": c("wheelchair_boarding").isin(*ACCESS_CODES)},
        "route": lambda: {
            "bad_route_type": within(c("route_type"), (0, 4)),
            "bad_route_color": hex_colour(c("route_color")),
            "bad_route_text_color": hex_colour(c("route_text_color"))},
        "trip": lambda: {
            "bad_direction_id": within(c("direction_id"), (0, 1)),
            "bad_wheelchair_accessible": c("wheelchair_accessible").isin(*ACCESS_CODES),
            "bad_bikes_allowed": c("bikes_allowed").isin(*ACCESS_CODES)},
        "prediction": lambda: {
            "delay_out_of_range": within(c("delay"), (-MAX_DELAY, MAX_DELAY)),
            "bad_arrival_time": soon(c("arrival_time"), now, MAX_AHEAD),
            "bad_departure_time": soon(c("departure_time"), now, MAX_AHEAD)},
        "vehicle_position": lambda: {
            "latitude_out_of_range": within(c("latitude"), (-90, 90)),
            "longitude_out_of_range": within(c("longitude"), (-180, 180)),
            "outside_area": _in_box("latitude", "longitude"),
            "speed_out_of_range": within(c("speed"), SPEED_RANGE),
            "too_old": young(c("timestamp"), now, POSITION_AGE),
            "bearing_out_of_range": within(c("bearing"), BEARING_RANGE)},
        "trip_update": lambda: {
            "too_old": young(c("timestamp"), now, UPDATE_AGE),
            "delay_out_of_range": within(c("delay"), (-MAX_DELAY, MAX_DELAY))},
        "alert": lambda: {
            "bad_period": c("effective_start_date") < c("effective_end_date"),
            "bad_severity": (c("alert_severity_level") == "") | c("alert_severity_level").isin(*severities)},
    }
    found |= specific[record_type]()
    if record_type == "alert" and alert_age is not None:
        found["too_old"] = young(c("effective_start_date"), now, alert_age)
    for score in ("confidence_score", "data_quality_score"):
        if score in df.columns:
            found[f"{score}_out_of_range"] = within(c(score), (0, 1))
    return found


def validate(df: DataFrame, record_type: str, as_of: AsOf = None, **options) -> DataFrame:
    """The records with an array of broken rules; empty for a good record."""
    broken = [F.when(~good, F.lit(name)) for name, good in rules(df, record_type, as_of, **options).items()]
    return df.withColumn(REASONS, F.array_compact(F.array(*broken)))


def valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(REASONS) == 0).drop(REASONS)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(REASONS) > 0)


def validation_stats(checked: DataFrame, by: str = "record_type") -> DataFrame:
    """Per type: processed, errors and the share of good records, 0 when there are none."""
    errors = F.count_if(F.size(REASONS) > 0)
    good = F.count_if(F.size(REASONS) == 0)
    return checked.groupBy(by).agg(
        row_count().alias("processed"), errors.alias("errors"),
        F.coalesce(r2(percent(good, row_count())), F.lit(0.0)).alias("success_rate"))


def rejects_by_rule(checked: DataFrame, by: str = "record_type") -> DataFrame:
    return checked.select(by, F.explode(REASONS).alias("rule")).groupBy(by, "rule").agg(
        row_count().alias("records"))
