"""Nested feed documents to typed records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.clock import AsOf, as_of_column
from tramline.functions.codes import (
    CONGESTION_LEVEL, OCCUPANCY_STATUS, SCHEDULE_RELATIONSHIP, instant, parse_time, to_code, wild_time)
from tramline.functions.measures import ratio
from tramline.schemas import RECORDS, TABLES

LANGUAGE = "en"

# Columns that go along from a landed line to the store: the line itself and its place in the order of arrival.
CARRIED = ("raw", "position")


def carried(df: DataFrame) -> list[str]:
    return [c for c in CARRIED if c in df.columns]


def conform(df: DataFrame, record_type: str) -> DataFrame:
    """Exactly the fields of a record type, in order; missing ones are null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in RECORDS[record_type]], *carried(df))


# JSON:API records

def _related(name: str) -> Column:
    return F.col(f"relationships.{name}.data.id")


def rest_predictions(raw: DataFrame) -> DataFrame:
    a = lambda name: F.col(f"attributes.{name}")
    return raw.where("type = 'prediction'").select(
        F.col("id").alias("prediction_id"),
        _related("trip").alias("trip_id"), _related("stop").alias("stop_id"),
        _related("route").alias("route_id"),
        parse_time(a("arrival_time")).alias("arrival_time"),
        parse_time(a("departure_time")).alias("departure_time"),
        a("schedule_relationship").alias("schedule_relationship"),
        a("vehicle.id").alias("vehicle_id"), a("vehicle.label").alias("vehicle_label"),
        a("status").alias("status"), a("delay").try_cast("int").alias("delay"), *carried(raw))


def rest_vehicles(raw: DataFrame) -> DataFrame:
    a = lambda name: F.col(f"attributes.{name}").alias(name)
    return raw.where("type = 'vehicle'").select(
        F.col("id").alias("vehicle_id"),
        F.col("attributes.trip.id").alias("trip_id"), _related("route").alias("route_id"),
        a("latitude"), a("longitude"), a("bearing"), a("speed"), a("current_status"),
        parse_time(F.col("attributes.updated_at")).alias("timestamp"),
        a("congestion_level"), a("occupancy_status"), *carried(raw))


def rest_unreadable(raw: DataFrame) -> DataFrame:
    """Records of a known type with a field that no typed record can hold, and which kind of field it is."""
    a = lambda name: F.col(f"attributes.{name}")
    wild = wild_time(a("arrival_time")) | wild_time(a("departure_time")) | wild_time(a("updated_at"))
    uneven = F.coalesce(a("delay") != a("delay").try_cast("int"), a("delay").isNotNull())
    return raw.where("type IN ('prediction', 'vehicle')").withColumn(
        "fault", F.when(wild, "wild_time").when(uneven, "bad_delay"))


def rest_unknown(raw: DataFrame) -> DataFrame:
    """Records of a type the pipeline does not know, for quarantine."""
    return raw.where("type IS NULL OR type NOT IN ('prediction', 'vehicle')")


def rest_part(decoded: DataFrame) -> DataFrame:
    """Decoded lines with the part of the pipeline that each one goes to."""
    kind = F.col("doc.type")
    return decoded.withColumn("part", F.when(F.col("corrupt").isNotNull(), "undecodable").when(
        kind.isin("prediction", "vehicle"), kind).otherwise("unknown"))


def route_directory(raw: DataFrame) -> DataFrame:
    """Route resources with a display name: the long name, else the id."""
    return raw.select(
        F.col("id").alias("route_id"),
        F.coalesce("attributes.long_name", "id").alias("name"),
        F.col("attributes.type").alias("type"), F.col("attributes.color").alias("color"),
        F.col("attributes.text_color").alias("text_color"))


# Feed messages

def feed_entities(messages: DataFrame) -> DataFrame:
    """One row per entity, with the header time as an instant."""
    return messages.select(
        instant(F.col("header.timestamp")).alias("feed_timestamp"),
        F.col("header.gtfs_realtime_version").alias("feed_version"),
        wild_time(F.col("header.timestamp")).alias("wild_header"),
        F.explode("entity").alias("entity"), *carried(messages))


def wild_entity() -> Column:
    """Whether an entity, or the header of its message, has a time that is no instant."""
    periods = F.coalesce(
        F.col("entity.alert.active_period"), F.array().cast("array<struct<start:bigint,end:bigint>>"))
    return (
        F.col("wild_header") | wild_time(F.col("entity.vehicle.timestamp"))
        | F.exists(periods, lambda p: wild_time(p["start"]) | wild_time(p["end"])))


def entity_kinds(entities: DataFrame) -> DataFrame:
    """What each entity carries; one that carries several things counts for each."""
    kinds = [F.when(F.col(f"entity.{k}").isNotNull(), k) for k in ("vehicle", "trip_update", "alert")]
    return entities.select(F.explode(F.array_compact(F.array(*kinds))).alias("entity"))


def feed_positions(entities: DataFrame) -> DataFrame:
    v = lambda name: F.col(f"entity.vehicle.{name}")
    return entities.where(F.col("entity.vehicle").isNotNull()).select(
        F.coalesce(v("vehicle.id"), F.col("entity.id")).alias("vehicle_id"),
        v("trip.trip_id").alias("trip_id"), v("trip.route_id").alias("route_id"),
        v("position.latitude").alias("latitude"), v("position.longitude").alias("longitude"),
        v("position.bearing").alias("bearing"), v("position.speed").alias("speed"),
        v("current_status").alias("current_status"),
        instant(v("timestamp")).alias("timestamp"),
        v("congestion_level").alias("congestion_level"),
        v("occupancy_status").alias("occupancy_status"), "feed_timestamp", *carried(entities))


def mean_stop_delay(stop_events: Column) -> Column:
    """Mean of the non-zero arrival and departure delays; null when there are none."""
    counted = F.filter(
        F.concat(stop_events["arrival"]["delay"], stop_events["departure"]["delay"]), lambda d: d != 0)
    total = F.aggregate(counted, F.lit(0).cast("bigint"), lambda total, d: total + d)
    return ratio(total, F.size(counted))


def feed_trip_updates(entities: DataFrame) -> DataFrame:
    u = lambda name: F.col(f"entity.trip_update.{name}")
    stops = F.coalesce(u("stop_time_update"), F.array().cast(RECORDS["trip_update"]["stop_time_updates"].dataType))
    return entities.where(F.col("entity.trip_update").isNotNull()).select(
        F.coalesce(u("trip.trip_id"), F.col("entity.id")).alias("trip_id"),
        u("vehicle.id").alias("vehicle_id"), u("trip.route_id").alias("route_id"),
        F.col("feed_timestamp").alias("timestamp"),
        mean_stop_delay(stops).alias("delay"), stops.alias("stop_time_updates"), "feed_timestamp",
        *carried(entities))


def last_given(periods: Column, field: str) -> Column:
    """The last period that states ``field`` decides it."""
    given = F.filter(F.transform(periods, lambda p: p[field]), lambda t: t.isNotNull())
    return instant(F.try_element_at(given, F.lit(-1)))


def first_text(translations: Column, language: str = LANGUAGE) -> Column:
    match = F.filter(translations, lambda t: t["language"] == language)
    return F.try_element_at(match, F.lit(1))["text"]


def _named(entities: Column, pick) -> Column:
    return F.coalesce(
        F.filter(F.transform(entities, pick), lambda x: x.isNotNull()),
        F.array().cast("array<string>"))


def feed_alerts(entities: DataFrame) -> DataFrame:
    a = lambda name: F.col(f"entity.alert.{name}")
    informed = a("informed_entity")
    return entities.where(F.col("entity.alert").isNotNull()).select(
        F.col("entity.id").alias("alert_id"),
        first_text(a("header_text.translation")).alias("alert_header_text"),
        first_text(a("description_text.translation")).alias("alert_description_text"),
        first_text(a("url.translation")).alias("alert_url"),
        last_given(a("active_period"), "start").alias("effective_start_date"),
        last_given(a("active_period"), "end").alias("effective_end_date"),
        _named(informed, lambda e: e["route_id"]).alias("affected_routes"),
        _named(informed, lambda e: e["stop_id"]).alias("affected_stops"),
        _named(informed, lambda e: e["trip"]["trip_id"]).alias("affected_trips"),
        a("severity_level").alias("alert_severity_level"), a("cause").alias("cause"),
        a("effect").alias("effect"), "feed_timestamp", *carried(entities))


# Loose records

def record_type(df: DataFrame) -> DataFrame:
    """Name the type of each loose record: the stated one, else the most specific match."""
    has = lambda name: F.col(name).isNotNull()
    return df.withColumn("record_type", F.coalesce(
        F.when(F.col("record_type").isin(*RECORDS), F.col("record_type")),
        F.when(has("prediction_id"), "prediction"),
        F.when(has("trip_id") & has("stop_time_updates"), "trip_update"),
        F.when(has("vehicle_id") & has("latitude") & has("longitude"), "vehicle_position"),
        F.when(has("alert_id") | has("alert_header_text"), "alert"),
        F.when(has("stop_id") & has("stop_name"), "stop"),
        F.when(has("route_id") & has("route_name"), "route"),
        F.when(has("trip_id") & has("route_id"), "trip")))


_TIMES = {"arrival_time", "departure_time", "timestamp", "effective_start_date", "effective_end_date"}
_EMPTY_WHEN_MISSING = {"stop_time_updates", "affected_routes", "affected_stops", "affected_trips"}
# Field names accepted in place of the usual ones.
_FALLBACKS = {
    "alert_id": ["id"],
    "alert_header_text": ["header_text"],
    "alert_description_text": ["description_text"],
    "alert_url": ["url"],
    "alert_severity_level": ["severity_level"],
}


def typed_records(loose: DataFrame, kind: str) -> DataFrame:
    """The loose records of one type with its fields and types."""
    def column(field):
        value = F.coalesce(*[F.col(n) for n in [field.name, *_FALLBACKS.get(field.name, [])]])
        if field.name == "alert_id":
            value = F.coalesce(value, F.lit("unknown"))
        if field.name in _TIMES:
            value = parse_time(value)
        if field.name in _EMPTY_WHEN_MISSING:
            value = F.coalesce(value, F.array().cast(field.dataType))
        return value.cast(field.dataType).alias(field.name)
    return loose.where(F.col("record_type") == kind).select(*[column(f) for f in RECORDS[kind]], *carried(loose))


def loose_wild(loose: DataFrame) -> Column:
    """Whether a loose record has a time that is no instant."""
    return reduce(lambda a, b: a | b, [wild_time(F.col(c)) for c in sorted(_TIMES)])


def untyped(loose: DataFrame) -> DataFrame:
    return loose.where("record_type IS NULL")


# Records to table rows

def with_lineage(df: DataFrame, source: str, batch_id: str, as_of: AsOf = None) -> DataFrame:
    now = as_of_column(as_of)
    created = F.coalesce("created_at", now) if "created_at" in df.columns else now
    day = F.date_format(created, "yyyy-MM-dd")
    if "partition_date" in df.columns:
        day = F.coalesce(F.col("partition_date"), day)
    return df.withColumns({
        "created_at": created, "processed_at": now, "source": F.lit(source), "version": F.lit("1.0"),
        "batch_id": F.lit(batch_id), "partition_date": day})


def row_key(*columns: str) -> Column:
    """A repeatable id from the natural key."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)


def _day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def table_rows(
    df: DataFrame, kind: str, as_of: AsOf = None, batch_id: str = "0", source: str | None = None,
) -> DataFrame:
    """Records of one type as rows of the table that stores them.

    Predictions and alerts are stamped with the ingest time, positions and trip
    updates keep the time of their source. Facts also say which batch and source
    they came with and when they were processed.
    """
    c, now = F.col, as_of_column(as_of)
    df = df.withColumns({"source": F.lit(source or kind), "processed_at": now, "batch_id": F.lit(batch_id)})
    if kind == "prediction":
        named = df.withColumns({
            "id": row_key("trip_id", "stop_id", "arrival_time"),
            "schedule_relationship": to_code(c("schedule_relationship"), SCHEDULE_RELATIONSHIP),
            "timestamp": now,
            "partition_date": F.date_format(now, "yyyy-MM-dd"),
            "arrival_date": F.coalesce(_day("arrival_time"), F.lit("none"))})
        table = "predictions"
    elif kind == "vehicle_position":
        named = df.withColumns({
            "id": row_key("vehicle_id", "timestamp", "latitude", "longitude"),
            "congestion_level": to_code(c("congestion_level"), CONGESTION_LEVEL),
            "occupancy_status": to_code(c("occupancy_status"), OCCUPANCY_STATUS),
            "partition_date": _day("timestamp")})
        table = "vehicle_positions"
    elif kind == "trip_update":
        named = df.withColumns({
            "id": row_key("trip_id", "vehicle_id", "timestamp"),
            "partition_date": _day("timestamp")})
        table = "trip_updates"
    elif kind == "alert":
        named = df.withColumnsRenamed({
            "effect": "alert_effect", "affected_routes": "affected_route_ids",
            "affected_stops": "affected_stop_ids", "affected_trips": "affected_trip_ids",
            "effective_start_date": "active_period_start", "effective_end_date": "active_period_end",
        }).withColumns({"timestamp": now, "partition_date": F.date_format(now, "yyyy-MM-dd")})
        table = "alerts"
    elif kind in ("stop", "route", "trip"):
        named = df.withColumnRenamed(f"{kind}_id", "id")
        table = f"{kind}s"
    else:
        raise ValueError(f"no table for {kind!r}")
    have = set(named.columns)
    return named.select(*[
        (c(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in TABLES[table]], *[x for x in carried(df) if x == "position"])
