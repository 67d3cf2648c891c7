"""Summaries by route, stop, type and time window, and the documents built from them.

A summary over several record types stacks narrow projections of them and
aggregates once, so it costs one shuffle of partial results and no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.clock import AsOf, ago, as_of_column, recent
from tramline.functions.measures import (
    SEVERE_SECONDS, is_late, lateness, percent, r2, ratio, row_count, zero_if_null)
from tramline.operators.enrich import region_of
from tramline.operators.shape import as_map, fold, stack, tagged
from tramline.plans import rules

# Lower edges of minor, moderate and major delays, in seconds.
DELAY_EDGES = (0, 300, 900)


def _kind(name: str) -> Column:
    return F.count_if(F.col("kind") == name)


def _delay_stats(nonzero: bool) -> list[Column]:
    """Mean, greatest and least delay; 0 where there is none."""
    d = F.when(F.col("delay") != 0, F.col("delay")) if nonzero else F.col("delay")
    return [
        F.coalesce(ratio(F.sum(d.cast("bigint")), F.count(d)), F.lit(0.0)).alias("avg_delay"),
        zero_if_null(F.max(d)).alias("max_delay"),
        zero_if_null(F.min(d)).alias("min_delay")]


def breakdown(edges: tuple[int, int, int] = DELAY_EDGES) -> list[Column]:
    d = F.col("delay")
    low, mid, high = edges
    return [
        F.count_if((d > low) & (d <= mid)).alias("minor"),
        F.count_if((d > mid) & (d <= high)).alias("moderate"),
        F.count_if(d > high).alias("major")]


def route_summary(predictions: DataFrame, positions: DataFrame, alerts: DataFrame) -> DataFrame:
    rows = stack(
        tagged("prediction", predictions, "route_id", "delay"),
        tagged("position", positions.where("route_id IS NOT NULL"), "route_id"),
        tagged("alert", alerts.select(F.explode("affected_route_ids").alias("route_id")), "route_id"))
    return rows.groupBy("route_id").agg(
        _kind("prediction").alias("predictions"), _kind("position").alias("vehicle_positions"),
        _kind("alert").alias("alerts"), *_delay_stats(nonzero=True))


def stop_summary(predictions: DataFrame, alerts: DataFrame) -> DataFrame:
    rows = stack(
        tagged("prediction", predictions, "stop_id", "delay"),
        tagged("alert", alerts.select(F.explode("affected_stop_ids").alias("stop_id")), "stop_id"))
    return rows.groupBy("stop_id").agg(
        _kind("prediction").alias("predictions"), _kind("alert").alias("alerts"),
        *_delay_stats(nonzero=True))


def time_window_summary(
    predictions: DataFrame, positions: DataFrame, trip_updates: DataFrame, alerts: DataFrame,
    as_of: AsOf = None, hours: float = 1,
) -> DataFrame:
    """What falls at or after ``as_of - hours``; predictions by their arrival time."""
    since = ago(as_of, hours)
    later = lambda c: F.col(c) >= since
    rows = stack(
        tagged("prediction", predictions.where(later("arrival_time")), "delay"),
        tagged("position", positions.where(later("timestamp"))),
        tagged("update", trip_updates.where(later("timestamp"))),
        tagged("alert", alerts.where(later("active_period_start") | later("active_period_end"))))
    return rows.agg(
        since.alias("start_time"), as_of_column(as_of).alias("end_time"),
        _kind("prediction").alias("predictions"), _kind("position").alias("vehicle_positions"),
        _kind("update").alias("trip_updates"), _kind("alert").alias("alerts"),
        *_delay_stats(nonzero=True))


def service_health(
    predictions: DataFrame, positions: DataFrame, alerts: DataFrame,
    edges: tuple[int, int, int] = DELAY_EDGES,
) -> DataFrame:
    rows = stack(
        tagged("prediction", predictions, "delay"), tagged("position", positions), tagged("alert", alerts))
    share = F.coalesce(percent(F.count_if(is_late(F.col("delay"))), _kind("prediction")), F.lit(0.0))
    return rows.agg(
        _kind("prediction").alias("total_predictions"), _kind("position").alias("total_vehicles"),
        _kind("alert").alias("total_alerts"), share.alias("share"), *breakdown(edges),
    ).select(
        "total_predictions", "total_vehicles", "total_alerts",
        r2(F.col("share")).alias("delay_percentage"), "minor", "moderate", "major",
        rules.service_status(F.col("share"), F.col("total_alerts")).alias("service_status"))


def type_summary(frames: dict[str, DataFrame], as_of: AsOf = None) -> DataFrame:
    """Count, first and last time per record type; types without a time are seen at ``as_of``."""
    clock = as_of_column(as_of)
    rows = stack(*[
        df.select(F.lit(kind).alias("record_type"),
                  (F.col("timestamp") if "timestamp" in df.columns else clock).alias("seen"))
        for kind, df in frames.items()])
    return rows.groupBy("record_type").agg(
        row_count().alias("count"), F.min("seen").alias("first_seen"), F.max("seen").alias("last_seen"))


def service_metrics(predictions: DataFrame, positions: DataFrame) -> DataFrame:
    served = predictions.groupBy("route_id", "stop_id").agg(
        row_count().alias("n"), F.count_if(is_late(F.col("delay"))).alias("late"))
    return fold(
        served.agg(
            zero_if_null(F.sum("n")).alias("total_predictions"),
            F.count_distinct("route_id").alias("active_routes"),
            F.count_distinct("stop_id").alias("active_stops"),
            zero_if_null(F.sum("late")).alias("delayed_predictions")),
        positions.agg(row_count().alias("total_vehicles")))


def performance_metrics(predictions: DataFrame) -> DataFrame:
    """Delay statistics over known delays, zeros included."""
    return predictions.agg(*_delay_stats(nonzero=False), F.count("delay").alias("delay_count"))


def alert_totals(alerts: DataFrame, as_of: AsOf = None) -> DataFrame:
    return alerts.agg(
        row_count().alias("total_alerts"),
        F.count_if(rules.alert_active(as_of_column(as_of))).alias("active_alerts"))


def alerts_by_severity(alerts: DataFrame) -> DataFrame:
    severity = F.col("alert_severity_level")
    return alerts.where(severity.isNotNull() & (severity != "")).groupBy("alert_severity_level").agg(
        row_count().alias("alerts"))


def alert_summary(alerts: DataFrame, as_of: AsOf = None) -> DataFrame:
    return fold(
        alert_totals(alerts, as_of),
        as_map(alerts_by_severity(alerts), "alert_severity_level", "alerts", "by_severity"))


def stops_by_region(stops: DataFrame) -> DataFrame:
    region = region_of(F.col("stop_lat"), F.col("stop_lon"))
    return stops.where("stop_lat <> 0 AND stop_lon <> 0").groupBy(region.alias("region")).agg(
        row_count().alias("stops"))


def geographic_summary(stops: DataFrame, positions: DataFrame) -> DataFrame:
    return fold(
        stops.agg(row_count().alias("total_stops")),
        positions.agg(row_count().alias("total_vehicles")),
        as_map(stops_by_region(stops), "region", "stops", "by_region"))


def summary_stats(tables, as_of: AsOf = None) -> DataFrame:
    """One row: all summaries together, the per-type ones as small maps."""
    frames = {
        "Stop": tables("stops"), "Route": tables("routes"), "Trip": tables("trips"),
        "Prediction": tables("predictions"), "VehiclePosition": tables("vehicle_positions"),
        "TripUpdate": tables("trip_updates"), "Alert": tables("alerts")}
    types = type_summary(frames, as_of).withColumn(
        "seen", F.struct("count", "first_seen", "last_seen"))
    counted = types.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("record_type", "seen")))).alias("by_type"),
        F.sum("count").alias("total_records"))
    as_doc = lambda df, name: df.select(F.struct("*").alias(name))
    return fold(
        counted,
        as_doc(service_metrics(frames["Prediction"], frames["VehiclePosition"]), "service_metrics"),
        as_doc(performance_metrics(frames["Prediction"]), "performance_metrics"),
        as_doc(alert_summary(frames["Alert"], as_of), "alert_summary"),
        as_doc(geographic_summary(frames["Stop"], frames["VehiclePosition"]), "geographic_summary"),
    ).withColumn("timestamp", as_of_column(as_of))


def stored_service_health(
    predictions: DataFrame, alerts: DataFrame, as_of: AsOf = None, hours: float = 24,
) -> DataFrame:
    return _facts_and_alerts(predictions, alerts, as_of, hours).agg(*_stored_health(hours))


def _facts_and_alerts(predictions: DataFrame, alerts: DataFrame, as_of: AsOf, hours: float) -> DataFrame:
    return stack(
        tagged("prediction", recent(predictions, as_of, hours), "delay"),
        tagged("alert", recent(alerts, as_of, hours)))


def _stored_health(hours: float) -> list[Column]:
    late = F.count_if(is_late(F.col("delay")))
    return [
        F.lit(float(hours)).alias("time_window_hours"),
        _kind("prediction").alias("total_predictions"), late.alias("delayed_predictions"),
        F.coalesce(r2(percent(late, _kind("prediction"))), F.lit(0.0)).alias("delay_percentage"),
        _kind("alert").alias("total_alerts")]


def on_time_performance(
    predictions: DataFrame, as_of: AsOf = None, hours: float = 1, route_id: str | None = None,
) -> DataFrame:
    """One row on all predictions of the window, of one route if it is given."""
    facts = recent(predictions, as_of, hours).select("route_id", "delay")
    if route_id is not None:
        facts = facts.where(F.col("route_id") == route_id)
    return facts.agg(*_on_time(row_count()))


def _on_time(n: Column) -> list[Column]:
    """The measures of ``n`` predictions; rows of other kinds have no delay."""
    d = F.col("delay")
    late = F.count_if(is_late(d))
    on_time = F.when(n == 0, 0.0).when(F.count(d) == 0, 100.0).otherwise(percent(n - late, n))
    return [
        on_time.alias("on_time_percentage"),
        F.coalesce(ratio(F.sum(d.cast("bigint")), F.count(d)), F.lit(0.0)).alias("average_delay"),
        F.coalesce(F.stddev_samp(d), F.lit(0.0)).alias("delay_std_dev"),
        n.alias("total_trips"), late.alias("delayed_trips"),
        F.count_if(d > SEVERE_SECONDS).alias("severely_delayed_trips")]


def route_on_time(
    predictions: DataFrame, routes: DataFrame, as_of: AsOf = None, hours: float = 24,
    with_data_only: bool = False,
) -> DataFrame:
    """Every route with its on-time share, 0 where there are no predictions."""
    d, n, late = F.col("delay"), F.col("n"), F.col("late")
    per_route = recent(predictions, as_of, hours).groupBy(F.col("route_id").alias("id")).agg(
        row_count().alias("n"), F.count_if(is_late(d)).alias("late"),
        F.sum(lateness(d).cast("bigint")).alias("late_s"))
    joined = routes.select("id", "route_name").join(per_route, "id", "inner" if with_data_only else "left")
    return joined.select(
        F.col("id").alias("route_id"), "route_name",
        zero_if_null(n).alias("total_predictions"), zero_if_null(late).alias("delayed_predictions"),
        zero_if_null(r2(percent(n - late, n))).alias("on_time_percentage"),
        zero_if_null(r2(ratio(F.col("late_s"), n * 60.0))).alias("avg_delay_minutes"),
    ).orderBy(F.desc("on_time_percentage"), "route_id")


def table_counts(frames: dict[str, DataFrame], as_of: AsOf = None) -> DataFrame:
    """Rows per table, and the predictions of the last hour."""
    last_hour = recent(frames["predictions"], as_of, 1)
    rows = stack(
        *[df.select(F.lit(name).alias("table_name")) for name, df in frames.items()],
        last_hour.select(F.lit("predictions_last_hour").alias("table_name")))
    names = frames["predictions"].sparkSession.range(1).select(F.explode(F.array(
        *[F.lit(n) for n in [*frames, "predictions_last_hour"]])).alias("table_name"))
    counted = rows.groupBy("table_name").agg(row_count().alias("rows"))
    return names.join(counted, "table_name", "left").select(
        "table_name", zero_if_null(F.col("rows")).alias("rows"))


def alert_cards(alerts: DataFrame, as_of: AsOf = None, hours: float = 24) -> DataFrame:
    return recent(alerts, as_of, hours).agg(
        row_count().alias("total_alerts"),
        F.count_if(F.col("alert_severity_level") == "SEVERE").alias("severe_alerts"),
        F.count("affected_route_ids").alias("routes_affected"))


def vehicles_per_route(positions: DataFrame) -> DataFrame:
    return positions.where("route_id IS NOT NULL").groupBy("route_id").agg(
        F.count_distinct("vehicle_id").alias("vehicles"))


def busiest_routes(positions: DataFrame, k: int = 3) -> DataFrame:
    return vehicles_per_route(positions).orderBy(F.desc("vehicles"), "route_id").limit(k)


def route_type_histogram(routes: DataFrame) -> DataFrame:
    return routes.groupBy("route_type").agg(row_count().alias("routes"))


def problem_routes(predictions: DataFrame, k: int | None = 5, edge: int = 120) -> DataFrame:
    counted = predictions.where(F.col("delay") > edge).groupBy("route_id").agg(row_count().alias("delays"))
    return counted if k is None else counted.orderBy(F.desc("delays"), "route_id").limit(k)


def vehicles_by_hour_of_day(positions: DataFrame) -> DataFrame:
    """24 rows: distinct vehicles seen in each hour of the day, 0 where none."""
    seen = positions.groupBy(F.hour("timestamp").alias("hour")).agg(
        F.count_distinct("vehicle_id").alias("vehicles"))
    day = positions.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    return day.join(F.broadcast(seen), "hour", "left").select(
        "hour", zero_if_null(F.col("vehicles")).alias("vehicles"))


def delay_distribution(predictions: DataFrame, edges: tuple[int, int, int] = (120, 300, 900)) -> DataFrame:
    d = F.when(F.col("delay") > edges[0], F.col("delay"))
    return predictions.agg(
        F.count(d).alias("total_delays"), *breakdown(edges),
        F.coalesce(r2(ratio(F.sum(d.cast("bigint")), F.count(d) * 60.0)), F.lit(0.0))
        .alias("average_delay_minutes"),
        F.coalesce(r2(F.max(d) / 60.0), F.lit(0.0)).alias("max_delay_minutes"))


def delays_with_routes(predictions: DataFrame, edges: tuple[int, int, int] = (120, 300, 900)) -> DataFrame:
    """One row from one reading: ``delays`` as delay_distribution() gives them, and ``problem_routes``, delays by route.

    Facts are counted per route first; the map is as long as the list of routes.
    """
    d = F.when(F.col("delay") > edges[0], F.col("delay"))
    per_route = predictions.groupBy("route_id").agg(
        F.count(d).alias("delays"), *breakdown(edges), F.sum(d.cast("bigint")).alias("total"), F.max(d).alias("most"))
    n = F.sum("delays")
    whole = [
        zero_if_null(n).alias("total_delays"), *[zero_if_null(F.sum(c)).alias(c) for c in ("minor", "moderate", "major")],
        F.coalesce(r2(ratio(F.sum("total"), n * 60.0)), F.lit(0.0)).alias("average_delay_minutes"),
        F.coalesce(r2(F.max("most") / 60.0), F.lit(0.0)).alias("max_delay_minutes")]
    entry = F.when(F.col("route_id").isNotNull() & (F.col("delays") > 0), F.struct("route_id", "delays"))
    return per_route.agg(
        F.struct(*whole).alias("delays"), F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("problem_routes"))


def vehicles_with_hours(positions: DataFrame) -> DataFrame:
    """One row from one reading: distinct vehicles, and of each hour of the day, as a list of 24.

    A vehicle's hours are the bits of one number, so the shuffle carries one row per vehicle.
    """
    hours = positions.groupBy("vehicle_id").agg(
        F.bit_or(F.expr("shiftleft(1, hour(timestamp))")).alias("hours")).where("vehicle_id IS NOT NULL")
    return hours.agg(
        row_count().alias("active_vehicles"),
        F.array(*[F.count_if(F.getbit("hours", F.lit(h)) == 1) for h in range(24)]).alias("hourly_vehicle_counts"))


def service_summary(
    predictions: DataFrame, alerts: DataFrame, as_of: AsOf = None, hours: float = 1,
) -> DataFrame:
    """One row: on-time performance, stored health, anomalies and the overall status.

    All counted measures come from one reading of both tables; only the anomalies' histogram reads them again.
    """
    found = rules.anomalies(predictions, alerts, as_of, hours).agg(
        F.collect_list(F.struct("anomaly_type", "severity", "description", "confidence_score"))
        .alias("anomalies"),
        F.count_if(F.col("severity") == "high").alias("high_anomalies"))
    measures = _facts_and_alerts(predictions, alerts, as_of, hours).agg(
        *_on_time(_kind("prediction")), *_stored_health(hours)).withColumn("average_delay_minutes", F.col("average_delay") / 60.0)
    parts = fold(measures.drop("average_delay", "delay_std_dev", "severely_delayed_trips"), found)
    score = rules.overall_score(
        F.col("on_time_percentage"), F.col("high_anomalies"), F.col("total_alerts"))
    return parts.withColumn("timestamp", as_of_column(as_of)).withColumn(
        "overall_status", rules.overall_status(score))


def latest_per_vehicle(positions: DataFrame) -> DataFrame:
    """The newest place of each vehicle."""
    newest_place = F.max_by(F.struct("route_id", "latitude", "longitude"), F.struct("timestamp", "id"))
    return positions.groupBy("vehicle_id").agg(
        newest_place.alias("place"), F.max("timestamp").alias("seen")).select(
        "vehicle_id", "place.*", "seen")


def latest_stats(tables, as_of: AsOf = None) -> dict[str, DataFrame]:
    """The published statistics: one totals row, and its lists as frames of their own.

    Only parts of a fixed length go into the totals row. Lists that grow with
    the fleet or the alerts stay distributed and are written beside it.
    """
    predictions, positions = tables("predictions"), tables("vehicle_positions")
    routes, alerts = tables("routes"), tables("alerts")
    active = alerts.where(rules.alert_active(as_of_column(as_of)))
    totals = fold(
        routes.agg(row_count().alias("total_routes")),
        vehicles_with_hours(positions),
        active.agg(row_count().alias("active_alerts")),
        delays_with_routes(predictions),
    ).withColumn("last_updated", as_of_column(as_of))
    return {
        "totals": totals,
        "route_vehicle_counts": vehicles_per_route(positions),
        "route_details": routes.select(
            F.col("id").alias("route_id"), F.col("route_name").alias("name"),
            F.col("route_type").alias("type"), F.col("route_color").alias("color")),
        "vehicle_locations": latest_per_vehicle(positions).select(
            F.col("route_id").alias("route"), F.col("latitude").alias("lat"),
            F.col("longitude").alias("lng")),
        "service_alerts": active.select(
            F.col("alert_header_text").alias("title"), F.col("alert_severity_level").alias("severity"),
            F.col("alert_effect").alias("description"),
            F.col("affected_route_ids").alias("affected_routes"),
            F.col("timestamp").alias("updated_at")),
    }
