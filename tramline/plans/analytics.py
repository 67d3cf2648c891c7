"""The twelve named reports.

Facts are aggregated before they meet a dimension: a dimension id is unique, so
the joins below see one row per key instead of the facts. Where a report counts
several distinct things, the facts are first reduced to one row per combination
of keys, so only that reduction is expanded and not the facts themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.clock import AsOf, on_spine, recent, up_to_hour
from tramline.functions.measures import (
    SEVERE_SECONDS, exact_speed, is_late, lateness, mean_speed, percent, r2, ratio, row_count, sample_stddev, zero_if_null)
from tramline.operators.headway import headway_moments

def _delay() -> Column:
    return F.col("delay")


def _facts(df: DataFrame, as_of: AsOf, hours: float | None, route_id: str | None = None) -> DataFrame:
    kept = recent(df, as_of, hours)
    return kept if route_id is None else kept.where(F.col("route_id") == route_id)


def _minutes(seconds: Column, n: Column) -> Column:
    return r2(ratio(seconds, n * 60.0))


def combine_delays(facts: DataFrame, *keys: str) -> DataFrame:
    """Delay counters per key combination; they add up over any coarser key."""
    return facts.groupBy(*keys).agg(
        row_count().alias("n"),
        F.count_if(is_late(_delay())).alias("late"),
        F.sum(lateness(_delay()).cast("bigint")).alias("late_s"),
        F.max("delay").alias("worst"))


def performance(
    predictions: DataFrame, routes: DataFrame, as_of: AsOf = None, hours: float = 24,
    route_id: str | None = None,
) -> DataFrame:
    late = lateness(_delay())
    per_route = _facts(predictions, as_of, hours, route_id).groupBy("route_id").agg(
        row_count().alias("total_predictions"),
        F.count_if(is_late(_delay())).alias("delayed_predictions"),
        F.count_if(_delay() > SEVERE_SECONDS).alias("severely_delayed"),
        F.sum(late.cast("bigint")).alias("late_s"),
        F.stddev_samp(late).alias("late_std"),
        F.sum(_delay().cast("bigint")).alias("delay_s"),
        F.count(_delay()).alias("known"))
    n = F.col("total_predictions")
    return (
        per_route.join(routes.select(F.col("id").alias("route_id"), "route_name"), "route_id")
        .select(
            "route_id", "route_name", n, "delayed_predictions", "severely_delayed",
            r2(percent(n - F.col("delayed_predictions"), n)).alias("on_time_percentage"),
            _minutes(F.col("late_s"), n).alias("avg_delay_minutes"),
            r2(F.col("late_std") / 60.0).alias("delay_std_dev_minutes"),
            _minutes(F.col("delay_s"), F.col("known")).alias("overall_avg_delay_minutes"))
        .orderBy(F.desc("on_time_percentage"), F.desc("total_predictions"), "route_id"))


def delays(
    predictions: DataFrame, as_of: AsOf = None, hours: float = 24, route_id: str | None = None,
) -> DataFrame:
    n, late = F.col("n"), F.col("late")
    hourly = (
        up_to_hour(_facts(predictions, as_of, hours, route_id), as_of)
        .groupBy(F.date_trunc("hour", "timestamp").alias("hour_bucket"))
        .agg(
            row_count().alias("n"), F.count_if(is_late(_delay())).alias("late"),
            F.sum(_delay().cast("bigint")).alias("delay_s"), F.count(_delay()).alias("known"),
            F.max("delay").alias("worst")))
    return (
        on_spine(hourly, as_of, hours)
        .select(
            "hour_bucket",
            zero_if_null(n).alias("total_predictions"),
            zero_if_null(late).alias("delayed_count"),
            zero_if_null(_minutes(F.col("delay_s"), F.col("known"))).alias("avg_delay_minutes"),
            zero_if_null(r2(F.col("worst") / 60.0)).alias("max_delay_minutes"),
            zero_if_null(r2(percent(late, n))).alias("delay_percentage"))
        .orderBy("hour_bucket"))


def _route_totals(predictions: DataFrame, as_of: AsOf, hours: float | None) -> DataFrame:
    combos = combine_delays(_facts(predictions, as_of, hours), "route_id", "trip_id", "stop_id")
    return combos.groupBy(F.col("route_id").alias("id")).agg(
        F.sum("n").alias("n"), F.sum("late").alias("late"), F.sum("late_s").alias("late_s"),
        F.max("worst").alias("worst"),
        F.count_distinct("trip_id").alias("trips"), F.count_distinct("stop_id").alias("stops"))


def route_comparison(
    predictions: DataFrame, routes: DataFrame, as_of: AsOf = None, hours: float = 24,
) -> DataFrame:
    """Every route, with or without predictions; no predictions leaves on-time null and 0 late."""
    n, late = F.col("n"), F.col("late")
    return (
        routes.select("id", "route_name", "route_type")
        .join(_route_totals(predictions, as_of, hours), "id", "left")
        .select(
            F.col("id").alias("route_id"), "route_name", "route_type",
            zero_if_null(n).alias("total_predictions"),
            zero_if_null(late).alias("delayed_predictions"),
            r2(percent(n - late, n)).alias("on_time_percentage"),
            zero_if_null(_minutes(F.col("late_s"), n)).alias("avg_delay_minutes"),
            r2(F.col("worst") / 60.0).alias("max_delay_minutes"),
            zero_if_null(F.col("trips")).alias("unique_trips"),
            zero_if_null(F.col("stops")).alias("unique_stops"))
        .orderBy(F.desc_nulls_last("on_time_percentage"), "route_id"))


def stop_performance(
    predictions: DataFrame, stops: DataFrame, as_of: AsOf = None, hours: float = 24,
    route_id: str | None = None, min_support: int = 5,
) -> DataFrame:
    n, late = F.col("n"), F.col("late")
    per_stop = combine_delays(
        _facts(predictions, as_of, hours, route_id), "stop_id").where(n >= min_support)
    return (
        stops.select(F.col("id").alias("stop_id"), "stop_name", "stop_lat", "stop_lon")
        .join(per_stop, "stop_id")
        .select(
            "stop_id", "stop_name", "stop_lat", "stop_lon",
            n.alias("total_predictions"), late.alias("delayed_predictions"),
            r2(percent(n - late, n)).alias("on_time_percentage"),
            _minutes(F.col("late_s"), n).alias("avg_delay_minutes"),
            F.expr("worst div 60").alias("max_delay_minutes"))
        .orderBy(F.desc("on_time_percentage"), "stop_id"))


def vehicle_activity(positions: DataFrame, as_of: AsOf = None, hours: float = 24) -> DataFrame:
    """Per hour: distinct vehicles, congestion and speed, with gaps filled."""
    count = F.col("vehicles")
    hourly = (
        up_to_hour(recent(positions, as_of, hours), as_of)
        .groupBy(F.date_trunc("hour", "timestamp").alias("hour_bucket"), "vehicle_id")
        .agg(
            F.count_if(F.col("congestion_level") > 0).alias("congested"),
            F.sum(exact_speed()).alias("speed_sum"), F.count("speed").alias("speed_n"),
            F.max("speed").alias("fastest"), F.min("speed").alias("slowest"))
        .groupBy("hour_bucket")
        .agg(
            F.count("vehicle_id").alias("vehicles"), F.sum("congested").alias("congested"),
            F.sum("speed_sum").alias("speed_sum"), F.sum("speed_n").alias("speed_n"),
            F.max("fastest").alias("fastest"), F.min("slowest").alias("slowest")))
    return (
        on_spine(hourly, as_of, hours)
        .select(
            "hour_bucket",
            zero_if_null(count).alias("vehicle_count"),
            zero_if_null(F.col("congested")).alias("congested_count"),
            zero_if_null(mean_speed(F.col("speed_sum"), F.col("speed_n"))).alias("avg_speed_mps"),
            zero_if_null(r2(F.col("fastest"))).alias("max_speed_mps"),
            zero_if_null(r2(F.col("slowest"))).alias("min_speed_mps"),
            F.when(count.isNull(), "No Data").when(count == 0, "No Vehicles")
            .when(count < 10, "Low Activity").when(count < 50, "Normal Activity")
            .otherwise("High Activity").alias("activity_level"))
        .orderBy("hour_bucket"))


def alert_overview(alerts: DataFrame, as_of: AsOf = None, hours: float = 24) -> DataFrame:
    """Per effect and severity; affected routes and stops count as whole sets, order ignored."""
    kinds = ["alert_effect", "alert_severity_level"]
    sets = (
        recent(alerts, as_of, hours)
        .groupBy(
            *kinds,
            F.array_sort("affected_route_ids").alias("route_set"),
            F.array_sort("affected_stop_ids").alias("stop_set"))
        .agg(row_count().alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last")))
    first, last = F.min("first"), F.max("last")
    return (
        sets.groupBy(*kinds)
        .agg(
            F.sum("n").alias("alert_count"),
            F.count_distinct("route_set").alias("affected_routes"),
            F.count_distinct("stop_set").alias("affected_stops"),
            first.alias("first_alert"), last.alias("last_alert"),
            r2((F.unix_micros(last) - F.unix_micros(first)) / 3_600_000_000.0).alias("duration_hours"))
        .orderBy(F.desc("alert_count"), *kinds))


def headways(
    positions: DataFrame, routes: DataFrame, as_of: AsOf = None, hours: float = 24,
    route_id: str | None = None, min_support: int = 5, bunch_s: float = 180, gap_s: float = 900,
) -> DataFrame:
    moments = headway_moments(_facts(positions, as_of, hours, route_id), bunch_s, gap_s)
    minutes = lambda c: r2(F.col(c) / 60.0)
    return (
        moments.where(F.col("total_headways") >= min_support)
        .join(routes.select(F.col("id").alias("route_id"), "route_name"), "route_id")
        .select(
            "route_id", "route_name", "direction_id", "total_headways",
            minutes("mean_s").alias("avg_headway_minutes"),
            r2(F.sqrt("variance_s") / 60.0).alias("headway_std_dev_minutes"),
            minutes("min_s").alias("min_headway_minutes"),
            minutes("max_s").alias("max_headway_minutes"),
            "bunching_incidents", "gap_incidents")
        .orderBy("avg_headway_minutes", "route_id", "direction_id"))


def peak_periods(
    predictions: DataFrame, as_of: AsOf = None, hours: float = 24, tz: str = "UTC",
) -> DataFrame:
    """Five periods of the day. ``tz`` is the zone whose clock decides the period."""
    local = F.col("timestamp") if tz == "UTC" else F.from_utc_timestamp("timestamp", tz)
    hour = F.hour(local)
    period = (
        F.when(hour.between(7, 9), 1).when(hour.between(16, 18), 2)
        .when(hour.between(10, 15), 3).when(hour.between(19, 22), 4).otherwise(5))
    # Period labels in display order.
    labels = F.array(*[F.lit(x) for x in (
        "Morning Peak (7-9 AM)", "Evening Peak (4-6 PM)", "Midday (10 AM-3 PM)",
        "Evening (7-10 PM)", "Late Night (11 PM-6 AM)")])
    facts = recent(predictions, as_of, hours).withColumn("period", period)
    n, late = F.col("n"), F.col("late")
    return (
        combine_delays(facts, "period")
        .orderBy("period")
        .select(
            F.element_at(labels, F.col("period")).alias("time_period"),
            n.alias("total_predictions"), late.alias("delayed_predictions"),
            r2(percent(n - late, n)).alias("on_time_percentage"),
            _minutes(F.col("late_s"), n).alias("avg_delay_minutes"),
            r2(F.col("worst") / 60.0).alias("max_delay_minutes")))


def delay_histogram(predictions: DataFrame, *keys: str) -> DataFrame:
    """Known delays counted per key and second, with first and last time seen."""
    return (
        predictions.where(_delay().isNotNull()).groupBy(*keys, "delay")
        .agg(row_count().alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last")))


def delay_anomalies(
    predictions: DataFrame, as_of: AsOf = None, hours: float = 24,
    z_high: float = 2, z_extreme: float = 3,
) -> DataFrame:
    """Delays far from the mean of their route, classified and counted.

    One pass over the facts builds a histogram of whole seconds per route, which
    holds all that the statistics and the classes need. The window then sees one
    row per distinct delay of a route, however many predictions it has.
    """
    by_route = Window.partitionBy("route_id")
    n, d = F.col("n").cast("decimal(38,0)"), F.col("delay").cast("decimal(38,0)")
    mean, spread = F.col("mean"), F.col("spread")
    scored = (
        delay_histogram(recent(predictions, as_of, hours), "route_id")
        .where(F.col("route_id").isNotNull())
        .withColumns({
            "rows": F.sum("n").over(by_route),
            "total": F.sum(n * d).over(by_route),
            "squares": F.sum(n * d * d).over(by_route)})
        .withColumns({
            "mean": ratio(F.col("total"), F.col("rows")),
            "spread": sample_stddev(F.col("rows"), F.col("total"), F.col("squares"))})
        .where(spread > 0)
        .withColumn(
            "anomaly_type",
            F.when(_delay() > mean + spread * z_extreme, "Extreme Delay")
            .when(_delay() > mean + spread * z_high, "High Delay")
            .when(_delay() < mean - spread * z_high, "Early Arrival"))
        .where(F.col("anomaly_type").isNotNull()))
    return (
        scored.groupBy("anomaly_type", "route_id")
        .agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * _delay()).alias("delay_s"),
            F.max("delay").alias("worst"), F.min("first").alias("first"), F.max("last").alias("last"))
        .groupBy("anomaly_type")
        .agg(
            F.sum("n").alias("count"),
            _minutes(F.sum("delay_s"), F.sum("n")).alias("avg_delay_minutes"),
            F.max("worst").alias("worst"),
            F.count("route_id").alias("affected_routes"),
            F.min("first").alias("first_occurrence"), F.max("last").alias("last_occurrence"))
        .select(
            "anomaly_type", "count", "avg_delay_minutes",
            F.expr("worst div 60").alias("max_delay_minutes"),
            "affected_routes", "first_occurrence", "last_occurrence")
        .orderBy(F.desc("count"), "anomaly_type"))


def realtime(
    predictions: DataFrame, positions: DataFrame, alerts: DataFrame, as_of: AsOf = None,
    hours: float = 1, high_values: tuple[str, ...] = ("high",),
) -> DataFrame:
    """Three tagged rows: predictions, vehicles, alerts. The first names the columns."""
    names = ["data_type", "count", "delayed_count", "avg_delay_minutes"]
    trains = recent(predictions, as_of, hours).agg(
        F.lit("predictions"), row_count(), F.count_if(is_late(_delay())),
        _minutes(F.sum(lateness(_delay()).cast("bigint")), row_count())).toDF(*names)
    fleet = recent(positions, as_of, hours).agg(
        F.lit("vehicles"), F.count_distinct("vehicle_id"), F.count_if(F.col("congestion_level") > 0),
        mean_speed(F.sum(exact_speed()), F.count("speed"))).toDF(*names)
    notices = recent(alerts, as_of, hours).agg(
        F.lit("alerts"), row_count(),
        F.count_if(F.col("alert_severity_level").isin(*high_values)), F.lit(0.0)).toDF(*names)
    return trains.unionByName(fleet).unionByName(notices)


# Area name and its closed box (lat from, lat to, lon from, lon to); first match wins.
AREAS = [
    ("Downtown Boston", 42.35, 42.37, -71.07, -71.05),
    ("Cambridge", 42.33, 42.35, -71.05, -71.03),
    ("Somerville", 42.37, 42.39, -71.05, -71.03),
    ("Brookline", 42.31, 42.33, -71.03, -71.01),
]


def area_of(lat: Column, lon: Column) -> Column:
    matches = [F.when(lat.between(a, b) & lon.between(c, d), name) for name, a, b, c, d in AREAS]
    return F.coalesce(*matches, F.lit("Other Areas"))


def geographic(
    predictions: DataFrame, stops: DataFrame, as_of: AsOf = None, hours: float = 24,
) -> DataFrame:
    lat, lon = F.col("stop_lat"), F.col("stop_lon")
    placed = stops.where(lat.isNotNull() & lon.isNotNull()).select(
        F.col("id").alias("stop_id"), area_of(lat, lon).alias("geographic_area"))
    n, late = F.sum("n"), F.sum("late")
    return (
        combine_delays(recent(predictions, as_of, hours), "stop_id", "route_id")
        .join(placed, "stop_id")
        .groupBy("geographic_area")
        .agg(
            n.alias("total_predictions"), late.alias("delayed_predictions"),
            r2(percent(n - late, n)).alias("on_time_percentage"),
            _minutes(F.sum("late_s"), n).alias("avg_delay_minutes"),
            F.count_distinct("route_id").alias("unique_routes"),
            F.count_distinct("stop_id").alias("unique_stops"))
        .orderBy(F.desc("total_predictions"), "geographic_area"))


def hourly_trends(
    predictions: DataFrame, as_of: AsOf = None, hours: float = 24, route_id: str | None = None,
) -> DataFrame:
    facts = up_to_hour(_facts(predictions, as_of, hours, route_id), as_of).withColumn(
        "hour_bucket", F.date_trunc("hour", "timestamp"))
    hourly = combine_delays(facts, "hour_bucket", "route_id", "stop_id").groupBy("hour_bucket").agg(
        F.sum("n").alias("n"), F.sum("late").alias("late"), F.sum("late_s").alias("late_s"),
        F.max("worst").alias("worst"),
        F.count_distinct("route_id").alias("active_routes"),
        F.count_distinct("stop_id").alias("active_stops"))
    n, late = F.col("n"), F.col("late")
    share = ratio(late, n)
    return (
        on_spine(hourly, as_of, hours)
        .select(
            "hour_bucket",
            zero_if_null(n).alias("total_predictions"),
            zero_if_null(late).alias("delayed_count"),
            zero_if_null(_minutes(F.col("late_s"), n)).alias("avg_delay_minutes"),
            zero_if_null(r2(F.col("worst") / 60.0)).alias("max_delay_minutes"),
            zero_if_null(F.col("active_routes")).alias("active_routes"),
            zero_if_null(F.col("active_stops")).alias("active_stops"),
            F.when(n.isNull(), "No Data").when(n == 0, "No Activity")
            .when(share > 0.3, "High Delays").when(share > 0.1, "Moderate Delays")
            .otherwise("Good Performance").alias("performance_status"))
        .orderBy("hour_bucket"))


# Report names as a caller asks for them: the function and the tables it reads.
REPORTS = {
    "performance": (performance, ("predictions", "routes")),
    "delays": (delays, ("predictions",)),
    "routes": (route_comparison, ("predictions", "routes")),
    "stops": (stop_performance, ("predictions", "stops")),
    "vehicles": (vehicle_activity, ("vehicle_positions",)),
    "alerts": (alert_overview, ("alerts",)),
    "headways": (headways, ("vehicle_positions", "routes")),
    "peak": (peak_periods, ("predictions",)),
    "anomalies": (delay_anomalies, ("predictions",)),
    "realtime": (realtime, ("predictions", "vehicle_positions", "alerts")),
    "geographic": (geographic, ("predictions", "stops")),
    "hourly_trends": (hourly_trends, ("predictions",)),
}


def report(name: str, tables, **parameters) -> DataFrame:
    """Run a named report; ``tables(name)`` gives each table it needs."""
    if name not in REPORTS:
        raise ValueError(f"unknown report {name!r}; one of {', '.join(REPORTS)}")
    function, needed = REPORTS[name]
    return function(*[tables(t) for t in needed], **parameters)
