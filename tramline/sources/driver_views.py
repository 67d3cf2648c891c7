"""The driver's test tables presented with the stored-table schemas.

All values are derived from the given rows by plain expressions, so the SQL
used to check the operators can derive the very same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared schemas save a pass over the footers. Reading the event time as a
# zoned timestamp lets time filters reach the scan.
EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
NATION = "n_nationkey int, n_name string, n_regionkey int"
SUPPLIER = "s_suppkey bigint, s_name string"
LINEITEM = (
    "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_returnflag string, l_shipdate timestamp")


def _read(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def route_code(n: Column) -> Column:
    text = n.cast("string")
    return (
        F.when(n == 3, "Red").when(n == 8, "Blue").when(n == 13, "Orange")
        .when(n % 5 == 0, F.concat(F.lit("CR-"), text))
        .when(n % 5 == 1, F.concat(F.lit("Green-"), text))
        .when(n % 5 == 2, F.concat(F.lit("SL"), text))
        .otherwise(text))


def minutes_after(ts: Column, minutes: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + minutes * 60_000_000)


def events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    if streaming:
        # A pattern matches the table whether it is one file or a folder of them.
        return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque[t]")
    return _read(spark, sf_dir, "events", EVENTS)


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return _read(spark, sf_dir, "nation", NATION).select(
        route_code(n).alias("id"),
        F.col("n_name").alias("route_name"),
        F.col("n_regionkey").alias("route_type"),
        F.lpad((n * 40009).cast("string"), 6, "0").alias("route_color"))


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    known = k % 17 != 16
    return _read(spark, sf_dir, "supplier", SUPPLIER).select(
        F.concat(F.lit("S"), k.cast("string")).alias("id"),
        F.col("s_name").alias("stop_name"),
        F.when(known, (42305 + 10 * (k % 10)) / 1000.0).alias("stop_lat"),
        F.when(known, -(71075 - 10 * (F.floor(k / 10) % 8)) / 1000.0).alias("stop_lon"),
        (k % 4).cast("int").alias("wheelchair_boarding"))


def _event_columns() -> dict[str, Column]:
    n, user, ts, kind = (F.col(c) for c in ("event_id", "user_id", "ts", "event_type"))
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return {
        "n": n, "user": user, "ts": ts, "kind": kind, "k": k,
        "trip": F.concat(F.lit("T"), user.cast("string")),
        "route": F.when(n % 97 == 0, "X-99").otherwise(route_code(user % 24)),
        "vehicle": F.concat(F.lit("V"), (n % 50).cast("string")),
        "stop": F.concat(F.lit("S"), k.cast("string")),
    }


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    return events(spark, sf_dir).select("user_id").distinct().select(
        F.concat(F.lit("T"), user.cast("string")).alias("id"),
        route_code(user % 24).alias("route_id"),
        F.lit("weekday").alias("service_id"),
        (user % 2).cast("int").alias("direction_id"))


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("n").cast("string")
    return events(spark, sf_dir).select((F.col("event_id") % 50).alias("n")).distinct().select(
        F.concat(F.lit("V"), label).alias("id"),
        F.concat(F.lit("V"), label).alias("vehicle_id"),
        F.concat(F.lit("Vehicle "), label).alias("vehicle_label"))


def predictions(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    e = _event_columns()
    arrival = F.when(e["n"] % 13 != 0, minutes_after(e["ts"], e["n"] % 140 - 10))
    return events(spark, sf_dir, streaming).select(
        e["n"].alias("id"),
        F.concat(F.lit("P"), e["n"].cast("string")).alias("prediction_id"),
        e["trip"].alias("trip_id"),
        e["route"].alias("route_id"),
        e["stop"].alias("stop_id"),
        e["vehicle"].alias("vehicle_id"),
        F.when(e["kind"] != "error", (F.floor(F.col("value") * 12) - 300).cast("int")).alias("delay"),
        arrival.alias("arrival_time"),
        F.when(arrival.isNotNull(), minutes_after(e["ts"], e["n"] % 140 - 8)).alias("departure_time"),
        F.element_at(
            F.array(*[F.lit(x) for x in ("scheduled", "ADDED", "canceled", "bogus")]),
            (e["n"] % 4 + 1).cast("int")).alias("schedule_relationship"),
        e["ts"].alias("timestamp"))


def vehicle_positions(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    e = _event_columns()
    return events(spark, sf_dir, streaming).select(
        e["n"].alias("id"),
        e["vehicle"].alias("vehicle_id"),
        e["trip"].alias("trip_id"),
        e["route"].alias("route_id"),
        (e["n"] % 2).cast("int").alias("direction_id"),
        ((42305 + e["n"] % 100) / 1000.0).alias("latitude"),
        (-(71075 - e["n"] % 80) / 1000.0).alias("longitude"),
        F.when(e["n"] % 19 != 0, (e["n"] * 7) % 6000).alias("speed_cms"),
        F.when(e["n"] % 19 != 0, ((e["n"] * 7) % 6000) / 100.0).alias("speed"),
        (e["n"] % 400).cast("double").alias("bearing"),
        F.when(e["kind"] != "view", (e["n"] % 4).cast("int")).alias("congestion_level"),
        e["ts"].alias("timestamp"),
        minutes_after(e["ts"], e["n"] % 45 - 3).alias("received_at"))


def alerts(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    e = _event_columns()
    names = lambda *xs: F.array(*[F.lit(x) for x in xs])
    second = F.when(e["n"] % 2 == 1, F.array(route_code((e["user"] + 1) % 24))).otherwise(
        F.array().cast("array<string>"))
    return events(spark, sf_dir, streaming).where(e["kind"] == "error").select(
        F.concat(F.lit("A"), e["n"].cast("string")).alias("alert_id"),
        F.concat(F.lit("Notice "), e["n"].cast("string")).alias("alert_header_text"),
        F.element_at(names("DETOUR", "DELAY", "NO_SERVICE", "OTHER"), e["k"] % 4 + 1).alias("alert_effect"),
        F.element_at(names("INFO", "WARNING", "SEVERE", "high", None), (e["n"] % 5 + 1).cast("int"))
        .alias("alert_severity_level"),
        F.concat(F.array(route_code(e["user"] % 24)), second).alias("affected_route_ids"),
        F.when(e["k"] % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(e["stop"]))
        .alias("affected_stop_ids"),
        e["ts"].alias("active_period_start"),
        F.when(e["n"] % 11 != 0, minutes_after(e["ts"], (e["n"] % 72 - 6) * 60)).alias("active_period_end"),
        e["ts"].alias("timestamp"))


def trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One update per order line; its stop list is spelled out from the line itself."""
    arrival = lambda i: (F.col("l_quantity").cast("int") * 20 - 300 + 30 * (i % 3)).cast("int")
    element = lambda i: F.struct(
        F.concat(F.lit("S"), (F.col("l_suppkey") + i).cast("string")).alias("stop_id"),
        i.cast("int").alias("stop_sequence"),
        F.when(i % 4 == 3, F.col("l_quantity").cast("int") * 25 - 400).cast("int").alias("delay"),
        F.struct(arrival(i).alias("delay"), F.lit(None).cast("bigint").alias("time")).alias("arrival"),
        F.struct(
            F.when(F.col("l_returnflag") != "N", arrival(i) + 10).alias("delay"),
            F.lit(None).cast("bigint").alias("time")).alias("departure"))
    return _read(spark, sf_dir, "lineitem", LINEITEM).select(
        F.concat(F.lit("T"), F.col("l_orderkey").cast("string")).alias("trip_id"),
        F.concat(F.lit("V"), (F.col("l_suppkey") % 50).cast("string")).alias("vehicle_id"),
        route_code(F.col("l_suppkey") % 24).alias("route_id"),
        F.col("l_shipdate").alias("timestamp"),
        minutes_after(F.col("l_shipdate"), F.col("l_orderkey") % 90).alias("received_at"),
        F.transform(F.sequence(F.lit(1), F.col("l_linenumber")), element).alias("stop_time_updates"))


VIEWS = {
    "routes": routes, "stops": stops, "trips": trips, "vehicles": vehicles,
    "predictions": predictions, "vehicle_positions": vehicle_positions,
    "alerts": alerts, "trip_updates": trip_updates,
}
