"""Live measures: windowed delays, trailing measures, sessions, totals and dedupe.

The watermark delays are the age limits that validation applies to the feeds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.measures import exact_speed, is_late, lateness, mean_speed, percent, r2, ratio, row_count

PREDICTION_DELAY = "2 hours"
POSITION_DELAY = "30 minutes"
UPDATE_DELAY = "1 hour"
ALERT_DELAY = "1 hour"
#: Relative standard error of estimated distinct counts.
ESTIMATE_ERROR = 0.02


def _measures() -> list:
    d = F.col("delay")
    return [
        row_count().alias("n"), F.count_if(is_late(d)).alias("late"),
        F.sum(lateness(d).cast("bigint")).alias("late_s"),
        F.sum(d.cast("bigint")).alias("delay_s"), F.count(d).alias("known"),
        F.max("delay").alias("worst")]


def hourly_delays(predictions: DataFrame, delay: str = PREDICTION_DELAY) -> DataFrame:
    """Closed hours with their delay measures; distinct routes and stops are estimates."""
    n, late = F.col("n"), F.col("late")
    return (
        predictions.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", "1 hour").alias("w"))
        .agg(*_measures(),
             F.approx_count_distinct("route_id", ESTIMATE_ERROR).alias("active_routes_estimate"),
             F.approx_count_distinct("stop_id", ESTIMATE_ERROR).alias("active_stops_estimate"))
        .select(
            F.col("w.start").alias("hour_bucket"),
            n.alias("total_predictions"), late.alias("delayed_count"),
            r2(ratio(F.col("delay_s"), F.col("known") * 60.0)).alias("avg_delay_minutes"),
            r2(F.col("worst") / 60.0).alias("max_delay_minutes"),
            r2(percent(late, n)).alias("delay_percentage"),
            "active_routes_estimate", "active_stops_estimate"))


def trailing_measures(
    predictions: DataFrame, delay: str = PREDICTION_DELAY, length: str = "1 hour", slide: str = "15 minutes",
) -> DataFrame:
    """The trailing hour, renewed every quarter of an hour."""
    n, late = F.col("n"), F.col("late")
    return (
        predictions.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", length, slide).alias("w"))
        .agg(*_measures())
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            n.alias("total_predictions"), late.alias("delayed_count"),
            r2(percent(n - late, n)).alias("on_time_percentage"),
            r2(ratio(F.col("late_s"), n * 60.0)).alias("avg_delay_minutes")))


#: Severities that the live card of alerts counts.
HIGH = ("high",)


def live_windows(
    predictions: DataFrame, positions: DataFrame, alerts: DataFrame, delays: tuple[str, str, str] = (
        PREDICTION_DELAY, POSITION_DELAY, ALERT_DELAY), length: str = "1 hour", slide: str = "15 minutes",
    high_values: tuple[str, ...] = HIGH, salts: int = 64,
) -> DataFrame:
    """The three live cards of ``analytics.realtime`` for every window in which any of three streams has a row.

    ``window_start, window_end, data_type, count, delayed_count,
    avg_delay_minutes``. Each stream has its own watermark and the slowest counts,
    so a window is put out once all of them have passed it. Rows are first added
    up by window and vehicle, rows without one by a hash, which also counts the
    vehicles exactly; a second aggregate, chained behind, adds these up.
    """
    number, wide = lambda x: F.lit(x).cast("bigint"), "decimal(28,6)"
    late, severe = is_late(F.col("delay")), F.col("alert_severity_level").isin(*high_values)
    one = lambda df, kind, delay, unit, flag, seconds, speed: df.withWatermark("timestamp", delay).select(
        "timestamp", F.lit(kind).alias("kind"), unit.alias("unit"), F.coalesce(flag, F.lit(False)).cast("bigint").alias("flagged"),
        seconds.alias("seconds"), speed.alias("speed"))
    salted = lambda df: F.pmod(F.xxhash64(*[c for c in df.columns if c != "timestamp"]), F.lit(salts)).cast("string")
    rows = one(predictions, "predictions", delays[0], salted(predictions), late, lateness(F.col("delay")).cast("bigint"), F.lit(None).cast(wide)) \
        .unionByName(one(positions, "vehicles", delays[1], F.col("vehicle_id"), F.col("congestion_level") > 0, number(None), exact_speed().cast(wide))) \
        .unionByName(one(alerts, "alerts", delays[2], salted(alerts), severe, number(None), F.lit(None).cast(wide)))
    parts = rows.groupBy(F.window("timestamp", length, slide).alias("w"), "kind", "unit").agg(
        row_count().alias("n"), F.sum("flagged").alias("flagged"), F.sum("seconds").alias("seconds"),
        F.sum("speed").alias("speed"), F.count("speed").alias("known"))
    of = lambda kind, value: F.when(F.col("kind") == kind, value)
    total = lambda kind, name: F.coalesce(F.sum(of(kind, F.col(name))), number(0)).alias(f"{kind}_{name}")
    sums = parts.groupBy("w").agg(
        *(total(k, x) for k in ("predictions", "alerts") for x in ("n", "flagged")),
        total("vehicles", "flagged"), total("vehicles", "known"), F.count(of("vehicles", F.col("unit"))).alias("vehicles_n"),
        F.sum(of("predictions", F.col("seconds"))).alias("seconds"), F.sum(of("vehicles", F.col("speed"))).alias("speed"))
    average = {"predictions": r2(ratio(F.col("seconds"), F.col("predictions_n") * 60.0)),
               "vehicles": mean_speed(F.col("speed"), F.col("vehicles_known")), "alerts": F.lit(0.0)}
    cards = F.array(*[F.struct(
        F.lit(k).alias("data_type"), F.col(f"{k}_n").alias("count"), F.col(f"{k}_flagged").alias("delayed_count"),
        a.cast("double").alias("avg_delay_minutes")) for k, a in average.items()])
    return sums.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), F.explode(cards).alias("card")) \
        .select("window_start", "window_end", "card.*")


def vehicle_sessions(positions: DataFrame, delay: str = POSITION_DELAY, gap: str = "30 minutes") -> DataFrame:
    """Spells of activity per vehicle, closed by a silence of ``gap``.

    Reports of a busy vehicle are merged into sessions before the shuffle.
    """
    positions.sparkSession.conf.set(
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return (
        positions.withWatermark("timestamp", delay)
        .groupBy(F.session_window("timestamp", gap).alias("s"), "vehicle_id")
        .agg(row_count().alias("reports"), F.max("speed").alias("max_speed"))
        .select(
            "vehicle_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
            "reports", "max_speed"))


def dedupe(predictions: DataFrame, delay: str = PREDICTION_DELAY, salts: int = 16) -> DataFrame:
    """One row of each prediction key within the watermark.

    Repeats of a busy key are first dropped in ``salts`` parts of their own, so
    the second pass sees no more than ``salts`` rows of a key.
    """
    keys = ["trip_id", "stop_id", "arrival_time"]
    salt = F.pmod(F.xxhash64(*[c for c in predictions.columns if c not in keys]), F.lit(salts))
    return (
        predictions.withWatermark("timestamp", delay)
        .withColumn("salt", salt).dropDuplicatesWithinWatermark([*keys, "salt"])
        .drop("salt").dropDuplicatesWithinWatermark(keys))


def running_totals(records: DataFrame) -> DataFrame:
    """Count, first and last time per record type, for update or complete mode."""
    return records.groupBy("record_type").agg(
        row_count().alias("count"), F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"))
