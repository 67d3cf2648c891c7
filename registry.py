"""Every operator as a query over the driver's test tables.

The clock is fixed so that results can be compared; the window covers the whole
tables unless a shorter one is the feature itself. Nested results are spelled
out as plain columns.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions import codes
from tramline.operators import enrich, flatten, headway, listing, referential, topk, upsert, validate
from tramline.operators.shape import stack
from tramline.plans import analytics, health, rules, summaries
from tramline.schemas import DOCUMENTS
from tramline.session import shared_dir
from tramline.sinks import commits, publish, store
from tramline.sources import feeds, tables
from tramline.sources.driver_views import VIEWS
from tramline.streaming import headway as live
from tramline.streaming import ingest, kpis, monitor, summary

AS_OF = dt.datetime(2024, 1, 31)
HOURS = 720
MID = dt.datetime(2024, 1, 16)
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


class Tables:
    """The views of one test folder, opened when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return VIEWS[name](self.spark, self.sf_dir)

    def __getattr__(self, name: str) -> DataFrame:
        return self(name)

    def stream(self, name: str) -> DataFrame:
        return VIEWS[name](self.spark, self.sf_dir, streaming=True)


def query(name: str):
    def add(function: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: function(Tables(spark, sf_dir))
        return function
    return add


def joined(column: str | Column) -> Column:
    return F.array_join(column, "|")


# The twelve named reports

def _named_report(name: str) -> None:
    window = {} if name == "realtime" else {"hours": HOURS}
    query(f"q_{name}")(lambda t: analytics.report(name, t, as_of=AS_OF, **window))


for _name in analytics.REPORTS:
    _named_report(_name)


def _one_route_report(name: str) -> None:
    query(f"q_{name}_one_route")(lambda t: analytics.report(name, t, as_of=AS_OF, hours=HOURS, route_id="Red"))


for _name in ("performance", "delays", "stops", "headways", "hourly_trends"):
    _one_route_report(_name)


# Summaries

@query("route_summary")
def _(t):
    return summaries.route_summary(t.predictions, t.vehicle_positions, t.alerts)


@query("stop_summary")
def _(t):
    return summaries.stop_summary(t.predictions, t.alerts)


@query("time_window_summary")
def _(t):
    return summaries.time_window_summary(
        t.predictions, t.vehicle_positions, t.trip_updates, t.alerts, AS_OF, HOURS)


@query("service_health")
def _(t):
    return summaries.service_health(t.predictions, t.vehicle_positions, t.alerts)


@query("type_summary")
def _(t):
    return summaries.type_summary({n: t(n) for n in VIEWS}, AS_OF)


@query("service_metrics")
def _(t):
    return summaries.service_metrics(t.predictions, t.vehicle_positions)


@query("performance_metrics")
def _(t):
    return summaries.performance_metrics(t.predictions)


@query("alert_totals")
def _(t):
    return summaries.alert_totals(t.alerts, AS_OF)


@query("alert_summary")
def _(t):
    return summaries.alert_summary(t.alerts, AS_OF).select(
        "total_alerts", "active_alerts", F.explode("by_severity").alias("severity", "alerts"))


@query("geographic_summary")
def _(t):
    return summaries.geographic_summary(t.stops, t.vehicle_positions).select(
        "total_stops", "total_vehicles", F.explode("by_region").alias("region", "stops"))


@query("summary_stats")
def _(t):
    doc = summaries.summary_stats(t, AS_OF)
    return doc.select(
        "timestamp", "total_records", F.col("by_type")["Prediction"]["count"].alias("predictions"),
        F.col("by_type")["VehiclePosition"]["last_seen"].alias("last_position"),
        F.col("by_type")["Stop"]["first_seen"].alias("stops_seen"),
        "service_metrics.active_routes", "service_metrics.active_stops",
        "service_metrics.delayed_predictions", "performance_metrics.avg_delay",
        "performance_metrics.delay_count", "alert_summary.active_alerts",
        F.col("alert_summary.by_severity")["SEVERE"].alias("severe_alerts"),
        "geographic_summary.total_stops")


@query("stored_service_health")
def _(t):
    return summaries.stored_service_health(t.predictions, t.alerts, AS_OF, HOURS)


def _on_time(t: Tables, **options) -> DataFrame:
    row = summaries.on_time_performance(t.predictions, AS_OF, HOURS, **options)
    return row.withColumn("delay_std_dev", analytics.r2(F.col("delay_std_dev")))


@query("window_performance")
def _(t):
    return _on_time(t)


@query("route_performance")
def _(t):
    return _on_time(t, route_id="Red")


@query("route_on_time_guarded")
def _(t):
    return summaries.route_on_time(t.predictions, t.routes, AS_OF, HOURS)


@query("route_on_time_with_data")
def _(t):
    return summaries.route_on_time(t.predictions, t.routes, AS_OF, HOURS, with_data_only=True)


@query("table_counts")
def _(t):
    return summaries.table_counts({n: t(n) for n in VIEWS if n != "vehicles"}, AS_OF)


@query("alert_cards")
def _(t):
    return summaries.alert_cards(t.alerts, AS_OF, HOURS)


@query("vehicles_per_route")
def _(t):
    return summaries.vehicles_per_route(t.vehicle_positions)


@query("busiest_routes")
def _(t):
    return summaries.busiest_routes(t.vehicle_positions)


@query("route_type_histogram")
def _(t):
    return summaries.route_type_histogram(t.routes)


@query("problem_routes_topk")
def _(t):
    return summaries.problem_routes(t.predictions)


@query("vehicles_by_hour_of_day")
def _(t):
    return summaries.vehicles_by_hour_of_day(t.vehicle_positions)


@query("delay_distribution")
def _(t):
    return summaries.delay_distribution(t.predictions)


@query("service_summary")
def _(t):
    doc = summaries.service_summary(t.predictions, t.alerts, AS_OF, HOURS)
    return doc.select(
        "timestamp", "time_window_hours", "on_time_percentage", "average_delay_minutes",
        "delayed_trips", "total_trips", "total_predictions", "delayed_predictions",
        "delay_percentage", "total_alerts", F.size("anomalies").cast("bigint").alias("anomalies"),
        "high_anomalies", "overall_status")


def _latest(t: Tables) -> dict[str, DataFrame]:
    return summaries.latest_stats(t, AS_OF)


@query("latest_stats")
def _(t):
    return _latest(t)["totals"].select(
        "total_routes", "active_vehicles", "active_alerts", "delays.*",
        joined(F.transform(F.array_sort(F.map_entries("problem_routes")), lambda e: F.concat_ws(":", e["key"], e["value"]))).alias("problem_routes"),
        joined(F.transform("hourly_vehicle_counts", lambda v: v.cast("string"))).alias("hourly_vehicle_counts"),
        "last_updated")


@query("latest_stats_route_vehicle_counts")
def _(t):
    return _latest(t)["route_vehicle_counts"]


@query("latest_stats_route_details")
def _(t):
    return _latest(t)["route_details"]


@query("latest_stats_vehicle_locations")
def _(t):
    return _latest(t)["vehicle_locations"]


@query("latest_stats_service_alerts")
def _(t):
    return _latest(t)["service_alerts"].withColumn("affected_routes", joined("affected_routes"))


# Rules

@query("delay_anomaly")
def _(t):
    return rules.delay_anomaly(t.predictions, AS_OF, HOURS).withColumns({
        "affected_routes": joined("affected_routes"), "affected_stops": joined("affected_stops")})


@query("service_disruption")
def _(t):
    return rules.service_disruption(t.alerts, AS_OF, HOURS).withColumns({
        "affected_routes": joined("affected_routes"), "affected_stops": joined("affected_stops")})


@query("headway_one_route")
def _(t):
    line = t.vehicle_positions.where("route_id = 'Red' AND direction_id = 0")
    return headway.headway_moments(line).select(
        "route_id", "direction_id", "total_headways",
        analytics.r2(F.col("mean_s")).alias("average_headway"),
        analytics.r2(F.col("variance_s") / 3600.0).alias("headway_variance_minutes"),
        "bunching_incidents", "gap_incidents")


@query("headway_route_in_window")
def _(t):
    return headway.headways_of(t.vehicle_positions, "Red", as_of=AS_OF, hours=360).select(
        "route_id", "direction_id", "total_headways",
        analytics.r2(F.col("mean_s")).alias("average_headway"), "bunching_incidents", "gap_incidents")


# Listings and top rows

@query("route_listing")
def _(t):
    return listing.route_listing(t.routes)


@query("stops_for_route")
def _(t):
    return listing.stop_listing(t.stops, t.predictions, "Red")


@query("stop_listing")
def _(t):
    return listing.stop_listing(t.stops)


@query("alert_listing")
def _(t):
    return listing.alert_listing(t.alerts)


@query("stops_in_box")
def _(t):
    return listing.stops_in_box(t.stops, (42.35, 42.37), (-71.07, -71.05))


@query("route_colours")
def _(t):
    return listing.route_colours(t.vehicle_positions, t.routes)


@query("recent_predictions")
def _(t):
    return topk.recent_predictions(t.predictions)


@query("recent_alerts")
def _(t):
    return topk.recent_alerts(t.alerts).select(
        "alert_id", "alert_header_text", "alert_severity_level", "active_period_start",
        "active_period_end", joined("affected_route_ids").alias("affected_routes"), "timestamp")


@query("recent_alerts_in_window")
def _(t):
    return topk.recent_alerts(t.alerts, 50, AS_OF, 360).select("alert_id", "alert_severity_level", "timestamp")


@query("kpi_last_points")
def _(t):
    hourly = analytics.delays(t.predictions, AS_OF, HOURS).select(
        F.lit("hourly_delays").alias("kind"), F.col("hour_bucket").alias("as_of"), "total_predictions")
    return topk.kpi_points(hourly)


# Typed records of the views, with the time each one came in as ``now``

def records(t: Tables, kind: str) -> DataFrame:
    if kind in ("stop", "route", "trip"):
        return flatten.conform(t(f"{kind}s").withColumnRenamed("id", f"{kind}_id"), kind)
    if kind == "prediction":
        view, now = t.predictions, F.col("timestamp")
    elif kind == "vehicle_position":
        view, now = t.vehicle_positions, F.col("received_at")
    elif kind == "trip_update":
        view, now = t.trip_updates, F.col("received_at")
        view = view.withColumn("delay", flatten.mean_stop_delay(F.col("stop_time_updates")))
    else:
        view, now = t.alerts, F.col("timestamp")
        view = view.withColumnsRenamed({
            "active_period_start": "effective_start_date", "active_period_end": "effective_end_date",
            "affected_route_ids": "affected_routes", "affected_stop_ids": "affected_stops",
            "alert_effect": "effect"}).withColumn("affected_trips", F.array().cast("array<string>"))
    fields = [f.name for f in flatten.RECORDS[kind]]
    padded = view.select("*", *[
        F.lit(None).cast(f.dataType).alias(f.name)
        for f in flatten.RECORDS[kind] if f.name not in view.columns])
    return padded.select(*fields, now.alias("now"))


ID = {
    "stop": "stop_id", "route": "route_id", "trip": "trip_id", "prediction": "prediction_id",
    "vehicle_position": "vehicle_id", "trip_update": "trip_id", "alert": "alert_id",
}


def checked(t: Tables, kind: str) -> DataFrame:
    df = records(t, kind)
    return validate.validate(df, kind, F.col("now") if "now" in df.columns else AS_OF)


def _validation(kind: str) -> None:
    @query(f"validate_{kind}")
    def _(t):
        return checked(t, kind).select(
            F.col(ID[kind]).alias("record_id"), (F.size(validate.REASONS) == 0).alias("is_valid"),
            joined(validate.REASONS).alias("reasons"))


for _kind in ID:
    _validation(_kind)


def _all_checked(t: Tables) -> DataFrame:
    return stack(*[
        checked(t, k).select(F.lit(k).alias("record_type"), validate.REASONS) for k in ID])


@query("validation_stats")
def _(t):
    return validate.validation_stats(_all_checked(t))


@query("rejected_by_rule")
def _(t):
    return validate.rejects_by_rule(_all_checked(t))


# Enrichment

def enriched(t: Tables, kind: str, **linked: DataFrame) -> DataFrame:
    return enrich.enrich(records(t, kind), kind, AS_OF, linked or None)


def _metadata(df: DataFrame, kind: str) -> DataFrame:
    names = [f.name for f in df.schema["metadata"].dataType if f.name != "enriched_at"]
    arrays = {"accessibility_features", "affected_services"}
    return df.select(F.col(ID[kind]).alias("record_id"), *[
        (joined(f"metadata.{n}") if n in arrays else F.col(f"metadata.{n}")).alias(n) for n in names])


def _enrichment(kind: str) -> None:
    query(f"enrich_{kind}")(lambda t: _metadata(enriched(t, kind), kind))


for _kind in ID:
    _enrichment(_kind)


def _dimensions(t: Tables) -> dict[str, DataFrame]:
    return {k: records(t, k) for k in ("stop", "route", "trip")}


@query("link_predictions")
def _(t):
    return enriched(t, "prediction", **_dimensions(t)).select(
        "prediction_id", F.col("trip_info.direction_id").alias("direction_id"),
        F.col("route_info.route_name").alias("route_name"), F.col("stop_info.stop_name").alias("stop_name"))


@query("link_positions")
def _(t):
    return enriched(t, "vehicle_position", **_dimensions(t)).select(
        "vehicle_id", "timestamp", F.col("trip_info.route_id").alias("trip_route"),
        F.col("route_info.route_type").alias("route_type"))


# Feed documents: the views as JSON text in the shape of the feeds, read back

def _ref(column: str) -> Column:
    return F.struct(F.struct(F.col(column).alias("id")).alias("data"))


def rest_prediction_lines(t: Tables) -> DataFrame:
    iso = lambda c: F.date_format(c, ISO).alias(c)
    return t.predictions.select(publish.as_json(
        F.col("prediction_id").alias("id"), F.lit("prediction").alias("type"),
        F.struct(
            iso("arrival_time"), iso("departure_time"), "schedule_relationship", "delay",
            F.struct(F.col("vehicle_id").alias("id")).alias("vehicle")).alias("attributes"),
        F.struct(
            _ref("stop_id").alias("stop"), _ref("trip_id").alias("trip"), _ref("route_id").alias("route"),
        ).alias("relationships")).alias("value"))


def rest_vehicle_lines(t: Tables) -> DataFrame:
    return t.vehicle_positions.select(publish.as_json(
        F.col("vehicle_id").alias("id"), F.lit("vehicle").alias("type"),
        F.struct(
            "latitude", "longitude", "bearing", "speed",
            F.date_format("timestamp", ISO).alias("updated_at"),
            F.element_at(F.array(*[F.lit(x) for x in ("low", "MEDIUM", "heavy", "none")]),
                         F.coalesce("congestion_level", F.lit(3)) + 1).alias("congestion_level"),
            F.struct(F.col("trip_id").alias("id")).alias("trip")).alias("attributes"),
        F.struct(_ref("route_id").alias("route")).alias("relationships")).alias("value"))


def rest_lines(t: Tables) -> DataFrame:
    """A mixed feed: both known types, one unknown type, and lines that are not JSON."""
    notices = t.alerts.select(publish.as_json(
        F.col("alert_id").alias("id"), F.lit("alert").alias("type")).alias("value"))
    broken = t.stops.select(F.concat(F.lit('{"id": "'), "id").alias("value"))
    return stack(rest_prediction_lines(t), rest_vehicle_lines(t), notices, broken)


@query("flatten_rest_predictions")
def _(t):
    return flatten.rest_predictions(feeds.rest_records(rest_lines(t)))


@query("flatten_rest_vehicles")
def _(t):
    return flatten.rest_vehicles(feeds.rest_records(rest_lines(t)))


@query("split_rest_feed")
def _(t):
    part = flatten.rest_part(feeds.decode(rest_lines(t), DOCUMENTS["rest"]))
    return part.groupBy("part").agg(F.count("*").alias("records"))


@query("combined_pull")
def _(t):
    pulled = feeds.combined_pull(feeds.rest_records(rest_lines(t)))
    return pulled.groupBy("type", F.col("relationships.route.data.id").alias("route_id")).agg(
        F.count("*").alias("records"))


@query("pick_predictions")
def _(t):
    raw = feeds.rest_records(rest_lines(t))
    return flatten.rest_predictions(feeds.pick_predictions(raw, ["Red", "Blue"], ["S1", "S2", "S3"])).select(
        "prediction_id", "route_id", "stop_id")


def route_resources(t: Tables) -> DataFrame:
    lines = t.routes.select(publish.as_json(
        "id", F.lit("route").alias("type"),
        F.struct(
            F.when(F.col("route_type") != 4, F.col("route_name")).alias("long_name"),
            F.col("route_type").alias("type"), F.col("route_color").alias("color")).alias("attributes"),
    ).alias("value"))
    return feeds.rest_records(lines)


@query("route_directory")
def _(t):
    return flatten.route_directory(feeds.pick_routes(route_resources(t)))


@query("pick_routes_by_type")
def _(t):
    return flatten.route_directory(feeds.pick_routes(route_resources(t), [0, 1])).select("route_id", "type")


def feed_lines(t: Tables) -> DataFrame:
    """Feed messages of one vehicle each, with the matching notice where there is one."""
    e = VIEWS["vehicle_positions"](t.spark, t.sf_dir)
    vehicle = F.struct(
        F.concat(F.lit("E"), F.col("id").cast("string")).alias("id"),
        F.struct(
            F.struct("trip_id", "route_id").alias("trip"),
            F.when(F.col("direction_id") == 0, F.struct(F.col("vehicle_id").alias("id"))).alias("vehicle"),
            F.struct("latitude", "longitude", "bearing", "speed").alias("position"),
            F.unix_seconds("timestamp").alias("timestamp")).alias("vehicle"))
    return e.select(publish.as_json(
        F.struct(F.lit("2.0").alias("gtfs_realtime_version"),
                 F.unix_seconds("received_at").alias("timestamp")).alias("header"),
        F.array(vehicle).alias("entity")).alias("value"))


@query("flatten_feed_positions")
def _(t):
    return flatten.feed_positions(flatten.feed_entities(feeds.feed_messages(feed_lines(t)))).drop(
        "current_status", "congestion_level", "occupancy_status")


@query("generic_feed_messages")
def _(t):
    """Nested messages with enum codes in messages, in lists of messages, missing and without a name."""
    n = F.col("id")
    stop = lambda code: F.struct(F.col("vehicle_id").alias("stop_id"), code.cast("int").alias("schedule_relationship"))
    body = F.struct(
        F.struct("trip_id", F.when(n % 5 == 4, 9).otherwise(n % 5).cast("int").alias("schedule_relationship")).alias("trip"),
        F.when(n % 4 < 3, n % 4).cast("int").alias("current_status"), (n % 6).cast("int").alias("congestion_level"),
        F.array(stop(n % 3), stop(F.lit(1))).alias("stop_time_update"))
    lines = t.vehicle_positions.select(publish.as_json(n.alias("id"), F.when(n % 7 != 0, body).alias("vehicle")).alias("value"))
    inner = "trip: struct<trip_id: string, schedule_relationship: int>, current_status: int, congestion_level: int, " \
        "stop_time_update: array<struct<stop_id: string, schedule_relationship: int>>"
    found = feeds.generic_messages(lines, f"id bigint, vehicle struct<{inner}>")
    return found.select(
        "id", "vehicle.trip.trip_id", F.col("vehicle.trip.schedule_relationship").alias("trip_relationship"),
        "vehicle.current_status", "vehicle.congestion_level",
        joined("vehicle.stop_time_update.schedule_relationship").alias("stop_relationships"))


def feed_update_lines(t: Tables) -> DataFrame:
    update = F.struct(
        F.concat(F.lit("U"), "trip_id").alias("id"),
        F.struct(
            F.struct("trip_id", "route_id").alias("trip"),
            F.struct(F.col("vehicle_id").alias("id")).alias("vehicle"),
            F.col("stop_time_updates").alias("stop_time_update")).alias("trip_update"))
    return t.trip_updates.select(publish.as_json(
        F.struct(F.unix_seconds("timestamp").alias("timestamp")).alias("header"),
        F.array(update).alias("entity")).alias("value"))


@query("flatten_feed_trip_updates")
def _(t):
    rows = flatten.feed_trip_updates(flatten.feed_entities(feeds.feed_messages(feed_update_lines(t))))
    return rows.select(
        "trip_id", "vehicle_id", "route_id", "timestamp", "delay",
        F.size("stop_time_updates").cast("bigint").alias("stop_events"),
        joined(F.transform("stop_time_updates", lambda s: s["stop_id"])).alias("stop_ids"))


def feed_alert_lines(t: Tables) -> DataFrame:
    """Alerts with two periods, two languages and one informed entity per route and stop."""
    text = lambda c: F.struct(F.array(
        F.struct(F.lit("avis").alias("text"), F.lit("fr").alias("language")),
        F.struct(F.col(c).alias("text"), F.lit("en").alias("language"))).alias("translation"))
    none = F.lit(None).cast("bigint")
    begin, end = F.unix_seconds("active_period_start"), F.unix_seconds("active_period_end")
    entity = lambda route, stop: F.struct(route.alias("route_id"), stop.alias("stop_id"))
    missing = F.lit(None).cast("string")
    body = F.struct(
        F.array(
            F.struct((begin - 60).alias("start"), none.alias("end")),
            F.struct(begin.alias("start"), end.alias("end"))).alias("active_period"),
        F.concat(
            F.transform("affected_route_ids", lambda r: entity(r, missing)),
            F.transform("affected_stop_ids", lambda s: entity(missing, s))).alias("informed_entity"),
        text("alert_header_text").alias("header_text"),
        F.col("alert_severity_level").alias("severity_level"), F.col("alert_effect").alias("effect"))
    return t.alerts.select(publish.as_json(
        F.struct(F.unix_seconds("timestamp").alias("timestamp")).alias("header"),
        F.array(F.struct(F.col("alert_id").alias("id"), body.alias("alert"))).alias("entity")).alias("value"))


@query("flatten_feed_alerts")
def _(t):
    rows = flatten.feed_alerts(flatten.feed_entities(feeds.feed_messages(feed_alert_lines(t))))
    return rows.select(
        "alert_id", "alert_header_text", "alert_description_text", "effective_start_date",
        "effective_end_date", joined("affected_routes").alias("affected_routes"),
        joined("affected_stops").alias("affected_stops"), "alert_severity_level", "effect")


@query("feed_entity_types")
def _(t):
    lines = stack(feed_lines(t), feed_update_lines(t), feed_alert_lines(t))
    entities = flatten.feed_entities(feeds.feed_messages(lines))
    return flatten.entity_kinds(entities).groupBy("entity").agg(F.count("*").alias("records"))


# Loose records: every view as untyped documents, told apart by their fields

def loose_lines(t: Tables) -> DataFrame:
    iso = lambda df: df.select(*[
        F.date_format(f.name, ISO).alias(f.name) if f.dataType.typeName() == "timestamp" else f.name
        for f in df.schema])
    documents = lambda kind: iso(records(t, kind).drop("now"))
    sparse = lambda df: df.select(F.to_json(F.struct("*")).alias("value"))
    alerts = documents("alert").withColumnsRenamed({
        "alert_id": "id", "alert_severity_level": "severity_level"})
    return stack(*[sparse(documents(k)) for k in ID if k != "alert"], sparse(alerts))


def loose_records(t: Tables) -> DataFrame:
    return flatten.record_type(feeds.documents(feeds.decode(loose_lines(t), DOCUMENTS["loose"])).drop("raw"))


@query("loose_record_types")
def _(t):
    return loose_records(t).groupBy("record_type").agg(F.count("*").alias("records"))


def _plain(df: DataFrame) -> DataFrame:
    def column(f):
        kind = f.dataType.typeName()
        if kind != "array":
            return F.col(f.name)
        element = f.dataType.elementType.typeName()
        return (joined(f.name) if element == "string" else F.size(f.name).cast("bigint")).alias(f.name)
    return df.select(*[column(f) for f in df.schema])


def _typed(kind: str) -> None:
    query(f"typed_{kind}")(lambda t: _plain(flatten.typed_records(loose_records(t), kind)))


for _kind in ID:
    _typed(_kind)


@query("parse_times")
def _(t):
    ts, n = F.col("timestamp"), F.col("id")
    text = (
        F.when(n % 6 == 0, F.date_format(ts, ISO))
        .when(n % 6 == 1, F.unix_seconds(ts).cast("string"))
        .when(n % 6 == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'-05:00'"))
        .when(n % 6 == 3, F.lit("soon"))
        .when(n % 6 == 4, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")))
    return t.predictions.select("id", codes.parse_time(text).alias("parsed"))


@query("code_mapping")
def _(t):
    names = F.array(*[F.lit(x) for x in ("EMPTY", "full", "2", "standing_room_only", "other")])
    return t.predictions.select(
        "id",
        codes.to_code(F.col("schedule_relationship"), codes.SCHEDULE_RELATIONSHIP).alias("schedule"),
        codes.to_code(F.element_at(names, (F.col("id") % 5 + 1).cast("int")), codes.OCCUPANCY_STATUS)
        .alias("occupancy"),
        codes.to_code(F.col("id") % 7, codes.CONGESTION_LEVEL).alias("congestion"))


@query("prediction_rows")
def _(t):
    return flatten.table_rows(records(t, "prediction"), "prediction", F.col("now"), "batch-1", "feed").drop("id", "status")


@query("alert_rows")
def _(t):
    return _plain(flatten.table_rows(records(t, "alert"), "alert", F.col("now"), "batch-1", "feed")).drop(
        "alert_description_text", "alert_url", "affected_trip_ids")


@query("position_rows")
def _(t):
    rows = flatten.table_rows(records(t, "vehicle_position"), "vehicle_position", F.col("now"), "batch-1", "feed")
    return rows.drop("id", "stop_id", "speed", "bearing")


@query("trip_update_rows")
def _(t):
    rows = flatten.table_rows(records(t, "trip_update"), "trip_update", F.col("now"), "batch-1", "feed")
    return rows.select("trip_id", "route_id", "delay", "timestamp", "source", "processed_at", "batch_id", "partition_date")


@query("flatten_rest_response")
def _(t):
    """Response documents that hold every record twice."""
    documents = rest_prediction_lines(t).select(F.concat(
        F.lit('{"data":['), "value", F.lit(","), "value", F.lit("]}")).alias("value"))
    return flatten.rest_predictions(feeds.rest_records(documents)).select("prediction_id", "trip_id", "stop_id", "route_id", "arrival_time", "delay")


@query("lineage")
def _(t):
    df = flatten.with_lineage(t.predictions.select("id", F.col("timestamp").alias("created_at")),
                              "rest_feed", "batch-1", AS_OF)
    return df.select("id", "created_at", "processed_at", "source", "version", "batch_id", "partition_date")


@query("trip_delay_from_stops")
def _(t):
    return t.trip_updates.select(
        "trip_id", "timestamp", flatten.mean_stop_delay(F.col("stop_time_updates")).alias("delay"))


@query("update_significance")
def _(t):
    events = F.col("stop_time_updates")
    return t.trip_updates.select(
        "trip_id", enrich.large_delays(events).cast("bigint").alias("large_delays"),
        enrich.update_significance(events).alias("significance"))


@query("affected_services")
def _(t):
    return t.alerts.select("alert_id", joined(enrich.affected_services(
        F.col("affected_route_ids"), F.col("affected_stop_ids"))).alias("services"))


# Insert-if-absent and placeholder rows

def _prediction_upsert(t: Tables) -> tuple[DataFrame, DataFrame]:
    """A store filled up to the middle of the month, and the whole feed sent twice."""
    rows = t.predictions.select("id", "trip_id", "stop_id", "arrival_time", "delay", "timestamp")
    held = upsert.first_per_key(rows.where(F.col("timestamp") < F.lit(MID)), upsert.KEYS["predictions"], "timestamp", "id")
    return rows.unionByName(rows), held


@query("upsert_predictions")
def _(t):
    batch, held = _prediction_upsert(t)
    return upsert.merge_absent(batch, held, upsert.KEYS["predictions"], "timestamp", "id")


@query("upsert_predictions_added")
def _(t):
    batch, held = _prediction_upsert(t)
    return upsert.new_rows(batch, held, upsert.KEYS["predictions"], "timestamp", "id")


@query("upsert_alerts")
def _(t):
    rows = t.alerts.select("alert_id", "alert_effect", "timestamp")
    held = rows.where(F.col("timestamp") < F.lit(MID))
    return upsert.new_rows(rows.unionByName(rows), held, upsert.KEYS["alerts"], "timestamp")


@query("upsert_trips")
def _(t):
    batch = t.trip_updates.select(F.col("trip_id").alias("id"), "route_id")
    return upsert.merge_absent(batch, t.trips.select("id", "route_id"), upsert.KEYS["trips"], "route_id")


@query("placeholder_routes")
def _(t):
    return referential.missing_routes(t.routes, t.predictions, t.vehicle_positions)


@query("placeholder_stops")
def _(t):
    """A directory that lacks the stops whose number ends in 7."""
    return referential.missing_stops(t.stops.where("id NOT LIKE '%7'"), t.predictions)


@query("placeholder_trips")
def _(t):
    return referential.missing_trips(t.trips, t.trip_updates, t.predictions)


@query("placeholder_vehicles")
def _(t):
    fleet = t.predictions.select(F.concat(F.lit("V"), F.substring("trip_id", 2, 20)).alias("vehicle_id"))
    return referential.missing_vehicles(t.vehicles, fleet, t.vehicle_positions)


@query("unknown_route")
def _(t):
    return referential.unknown_route(t.routes)


@query("seed_routes_kept")
def _(t):
    """A store without routes takes the seeds, one that has some takes none."""
    return stack(tables.seeded(t.routes.where("id = 'nowhere'")), tables.seeded(t.routes)).select("id", "route_name")


# Freshness, ingestion log, topics

@query("feed_freshness")
def _(t):
    clock = dt.datetime(2024, 1, 31, 0, 5)
    names = ("predictions", "vehicle_positions", "alerts", "trip_updates")
    return health.feed_freshness({n: t(n) for n in names}, clock)


def ingestion_log(t: Tables) -> DataFrame:
    """The predictions as log rows: one run per row, by vehicle, failed where the delay is unknown."""
    d = F.col("delay")
    return t.predictions.select(
        F.col("vehicle_id").alias("source_type"),
        F.when(d.isNull(), "error").when(d < 0, "partial").otherwise("success").alias("status"),
        F.abs(F.coalesce(d, F.lit(0))).cast("bigint").alias("records_processed"),
        F.greatest(F.coalesce(d, F.lit(0)), F.lit(0)).cast("bigint").alias("records_inserted"),
        F.when(d < 0, -d).otherwise(0).cast("bigint").alias("records_failed"),
        F.col("timestamp").alias("started_at"), F.col("timestamp").alias("completed_at"))


@query("ingestion_health")
def _(t):
    return health.ingestion_health(ingestion_log(t))


@query("trailing_minute_requests")
def _(t):
    return health.trailing_minute_requests(ingestion_log(t).withColumn("source_type", F.lit("feed")))


@query("pipeline_health")
def _(t):
    return health.pipeline_health(
        ingestion_log(t), summaries.service_health(t.predictions, t.vehicle_positions, t.alerts),
        summaries.type_summary({n: t(n) for n in ("predictions", "vehicle_positions", "alerts")}, AS_OF),
        summaries.on_time_performance(t.predictions, AS_OF, HOURS), AS_OF)


def typed_feeds(t: Tables) -> dict[str, DataFrame]:
    return {k: records(t, k).drop("now") for k in ("prediction", "vehicle_position", "alert", "trip_update", "stop")}


@query("topic_routing")
def _(t):
    sent = publish.route_messages(typed_feeds(t))
    return sent.groupBy("topic", "key").agg(
        F.count("*").alias("messages"), F.count("route_id").alias("with_route"))


@query("topic_payloads")
def _(t):
    sent = publish.route_messages({"prediction": records(t, "prediction").drop("now")})
    field = lambda name: F.get_json_object("value", f"$.{name}").alias(name)
    return sent.select("topic", "key", *[field(c) for c in ("prediction_id", "stop_id", "delay", "arrival_time", "vehicle_label")])


@query("kpi_snapshot")
def _(t):
    doc = summaries.service_health(t.predictions, t.vehicle_positions, t.alerts)
    row = publish.snapshot(doc, "service_health", AS_OF)
    field = lambda name: F.get_json_object("payload", f"$.{name}")
    return row.select(
        "kind", "as_of", field("total_predictions").cast("bigint").alias("total_predictions"),
        field("service_status").alias("service_status"))


# The store: everything written, then written again, then counted

def _stored_counts(spark: SparkSession, root: str, names: tuple[str, ...]) -> DataFrame:
    return stack(*[
        tables.read_table(spark, root, n).select(F.lit(n).alias("table_name")) for n in names
    ]).groupBy("table_name").agg(F.count("*").alias("rows"))


STORED = ("routes", "stops", "trips", "vehicles", "predictions", "vehicle_positions", "alerts", "trip_updates", "data_ingestion_logs")


@query("store_round_trip")
def _(t):
    root = shared_dir(t.spark, "store")
    store.initialise(t.spark, root)
    frames = {k: records(t, k).drop("now") for k in ID}
    for _ in range(2):
        store.store_all(frames, root, "batch-1", AS_OF)
    return _stored_counts(t.spark, root, STORED)


@query("store_replay")
def _(t):
    """Two batches of positions, some of no day: one stops between its files, is taken again, and then once more."""
    root, table = shared_dir(t.spark, "replay"), "vehicle_positions"
    store.initialise(t.spark, root)
    found = records(t, "vehicle_position").drop("now")
    found = found.withColumn("timestamp", F.when(F.col("bearing").isNull() | (F.col("bearing") % 7 != 0), F.col("timestamp")))
    halves = {"first": found.where("vehicle_id < 'V3'"), "second": found.where("NOT (vehicle_id < 'V3')")}
    rows = {k: flatten.table_rows(df, "vehicle_position", AS_OF, k) for k, df in halves.items()}
    commits.stage(rows["first"], root, table, "first", lambda df, path: store.write_files(df, path, table, "append"))
    commits.publish(t.spark, root, table, commits.batch_name("first"), most=1)
    for batch in ("first", "first", "second", "second"):
        store.append_once(rows[batch], root, table, batch)
    return tables.read_table(t.spark, root, table).groupBy("partition_date", "batch_id").agg(F.count("*").alias("rows"))


# Streams, run over all the rows there are and read back

FACTS = ("predictions", "vehicle_positions", "alerts", "trip_updates")


def _finished(t: Tables, stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    return ingest.stream_to_frame(t.spark, stream, shared_dir(t.spark, label), mode)


def _whole(t: Tables, label: str, make, *names: str, mode: str = "append") -> DataFrame:
    """The whole result over the rows there are, which arrive in two parts; with the operators' own watermarks."""
    return ingest.run_in_parts(
        t.spark, {n: t(n) for n in names}, lambda s: make(*[s[n] for n in names]), shared_dir(t.spark, label), (MID,), mode)


@query("stream_hourly_delays")
def _(t):
    """The estimates of distinct routes and stops are compared with exact counts: within three standard errors, or one."""
    found = _whole(t, "hourly", kpis.hourly_delays, "predictions")
    exact = t.predictions.groupBy(F.date_trunc("hour", "timestamp").alias("hour_bucket")).agg(
        F.count_distinct("route_id").alias("routes"), F.count_distinct("stop_id").alias("stops"))
    near = lambda of: (F.abs(F.col(f"active_{of}_estimate") - F.col(of)) <= F.greatest(F.col(of) * 3 * kpis.ESTIMATE_ERROR, F.lit(1))).alias(f"active_{of}_near")
    kept = [c for c in found.columns if not c.endswith("_estimate")]
    return found.join(exact, "hour_bucket", "left").select(*kept, near("routes"), near("stops"))


@query("stream_sliding_kpis")
def _(t):
    return _whole(t, "sliding", kpis.trailing_measures, "predictions")


@query("stream_live_cards")
def _(t):
    return _whole(t, "cards", kpis.live_windows, "predictions", "vehicle_positions", "alerts")


@query("stream_sessions")
def _(t):
    return _whole(t, "sessions", kpis.vehicle_sessions, "vehicle_positions")


@query("stream_dedupe")
def _(t):
    kept = _finished(t, kpis.dedupe(t.stream("predictions")), "dedupe")
    return kept.select("trip_id", "stop_id", "arrival_time").groupBy(
        "trip_id", "stop_id", "arrival_time").agg(F.count("*").alias("rows"))


@query("stream_running_totals")
def _(t):
    return _whole(
        t, "totals", lambda *streams: kpis.running_totals(stack(*[
            s.select(F.lit(n).alias("record_type"), "timestamp") for n, s in zip(FACTS, streams)])), *FACTS, mode="complete")


@query("stream_headways")
def _(t):
    return _whole(t, "headways", live.live_headways, "vehicle_positions")


@query("stream_feed_stalls")
def _(t):
    """Silences of two hours in the log; the closing row moves the clock past the last ones."""
    log = ingestion_log(t).drop("started_at")
    return ingest.run_in_parts(
        t.spark, {"log": log}, lambda s: monitor.feed_stalls(s["log"], "2 hours"), shared_dir(t.spark, "stalls"), (MID,),
        time="completed_at")


@query("kept_summary")
def _(t):
    """Predictions in three batches of which one is taken twice; the summary is the sum of their counters."""
    root = shared_dir(t.spark, "summary")
    store.initialise(t.spark, root)
    at, later = F.col("timestamp"), MID + dt.timedelta(days=3)
    batches = {"a": at < MID, "b": (at >= MID) & (at < later), "c": at >= later}
    for name in ("a", "b", "b", "c"):
        summary.add_batch(t.predictions.where(batches[name]), root, name)
    return summary.kept_performance(t.spark, root, t.routes, AS_OF, HOURS)


@query("stream_ingest")
def _(t):
    """The mixed feed landed as files, ingested as a stream at a fixed clock."""
    folder = shared_dir(t.spark, "ingest")
    rest_lines(t).write.text(f"{folder}/landed")
    root = f"{folder}/store"
    store.initialise(t.spark, root)
    clock = dt.datetime(2024, 1, 30, 12)
    lines = feeds.text_lines(t.spark, f"{folder}/landed", streaming=True)
    ingest.start_ingest(
        lines, root, f"{folder}/checkpoint", "feed", as_of=clock, trigger={"availableNow": True}, settled=True).awaitTermination()
    refused = tables.read_table(t.spark, root, "quarantine").select(
        F.concat(F.lit("refused_"), "kind").alias("table_name")).groupBy("table_name").agg(
        F.count("*").alias("rows"))
    return _stored_counts(t.spark, root, ("predictions", "vehicle_positions")).unionByName(refused)
