"""Summaries on small days with known answers."""

import datetime as dt

from pyspark.sql import functions as F

from tramline.operators import enrich
from tramline.plans import health, rules, summaries

NOW = dt.datetime(2024, 3, 1, 12)
H = dt.timedelta(hours=1)
P = "id bigint, route_id string, stop_id string, delay int, arrival_time timestamp, timestamp timestamp"
V = "id bigint, vehicle_id string, route_id string, timestamp timestamp"
A = ("alert_id string, affected_route_ids array<string>, affected_stop_ids array<string>, "
     "active_period_start timestamp, active_period_end timestamp, alert_severity_level string, timestamp timestamp")


def preds(spark, *rows):
    return spark.createDataFrame([(i, r, s, d, NOW, NOW) for i, (r, s, d) in enumerate(rows)], P)


def positions(spark, *route_ids):
    return spark.createDataFrame([(i, f"v{i}", r, NOW) for i, r in enumerate(route_ids)], V)


def alerts(spark, *rows):
    return spark.createDataFrame([
        (f"a{i}", routes, stops, start, end, "INFO", NOW) for i, (routes, stops, start, end) in enumerate(rows)], A)


def test_one_of_each(spark):
    p = preds(spark, ("Red", "stop_1", 120))
    a = alerts(spark, (["Red"], ["stop_1", "stop_2"], None, None))
    [red] = summaries.route_summary(p, positions(spark, "Red", None), a).collect()
    assert (red.predictions, red.vehicle_positions, red.alerts) == (1, 1, 1)
    assert (red.avg_delay, red.max_delay, red.min_delay) == (120.0, 120, 120)
    stops = {r.stop_id: r for r in summaries.stop_summary(p, a).collect()}
    assert (stops["stop_1"].predictions, stops["stop_1"].alerts, stops["stop_1"].avg_delay) == (1, 1, 120.0)
    assert (stops["stop_2"].predictions, stops["stop_2"].alerts, stops["stop_2"].avg_delay) == (0, 1, 0.0)
    row = summaries.service_health(p, positions(spark, "Red"), a).first()
    assert (row.delay_percentage, row.minor, row.moderate, row.service_status) == (100.0, 1, 0, "poor")


def test_zero_delays_count_only_where_they_should(spark):
    p = preds(spark, *[("Red", "s", d) for d in (0, 60, 300, 900, 1800)])
    row = summaries.performance_metrics(p).first()
    assert (row.avg_delay, row.max_delay, row.min_delay, row.delay_count) == (612.0, 1800, 0, 5)
    red = summaries.route_summary(p, positions(spark), alerts(spark)).first()
    assert (red.avg_delay, red.min_delay) == (765.0, 60)


def test_no_delays(spark):
    row = summaries.performance_metrics(preds(spark, ("Red", "s", None))).first()
    assert tuple(row) == (0.0, 0, 0, 0)
    assert tuple(summaries.performance_metrics(preds(spark)).first()) == (0.0, 0, 0, 0)


def test_alert_activity(spark):
    a = alerts(spark, ([], [], None, None), ([], [], NOW + H, None), ([], [], NOW - 2 * H, NOW - H),
               ([], [], NOW, NOW))
    row = summaries.alert_summary(a, NOW).first()
    assert (row.total_alerts, row.active_alerts, row.by_severity) == (4, 2, {"INFO": 4})


def test_status_rules(spark):
    cases = [(2.0, 1, "excellent"), (7.0, 3, "good"), (15.0, 7, "fair"), (25.0, 12, "poor"),
             (5.0, 2, "excellent"), (0.0, 11, "poor")]
    for share, n, want in cases:
        assert spark.range(1).select(rules.service_status(F.lit(share), F.lit(n))).first()[0] == want
    for on_time, high, n, score, want in [
            (95.0, 0, 0, 100, "excellent"), (89.9, 0, 6, 80, "excellent"), (79.0, 1, 6, 55, "fair"),
            (79.0, 3, 6, 25, "poor"), (90.0, 2, 5, 70, "good")]:
        c = rules.overall_score(F.lit(on_time), F.lit(high), F.lit(n))
        assert tuple(spark.range(1).select(c, rules.overall_status(c)).first()) == (score, want)


def test_demo_day(spark):
    p = preds(spark, ("Red", "a", 120), ("Red", "b", 300), ("Blue", "a", 0), ("Blue", "b", 900))
    a = alerts(spark, (["Red"], [], None, None), (["Blue"], [], None, None))
    v = positions(spark, "Red", "Blue")
    by_route = {r.route_id: r.avg_delay for r in summaries.route_summary(p, v, a).collect()}
    assert by_route == {"Red": 210.0, "Blue": 900.0}
    row = summaries.service_health(p, v, a).first()
    assert (row.delay_percentage, row.minor, row.moderate, row.major) == (75.0, 2, 1, 0)
    assert (row.total_alerts, row.service_status) == (2, "poor")


def test_performance_of_a_route_reads_its_whole_window(spark):
    rows = [(i, "Red" if i < 3000 else "Blue", "s", 60, NOW, NOW - dt.timedelta(seconds=i)) for i in range(3700)]
    p = spark.createDataFrame(rows, P)
    assert summaries.on_time_performance(p, NOW, 1, "Red").first().total_trips == 3000
    assert summaries.on_time_performance(p, NOW, 1, "Blue").first().total_trips == 601
    none = summaries.on_time_performance(p, NOW, 1, "Green").first()
    assert (none.on_time_percentage, none.total_trips, none.delay_std_dev) == (0.0, 0, 0.0)
    unknown = preds(spark, ("Red", "s", None))
    assert summaries.on_time_performance(unknown, NOW).first().on_time_percentage == 100.0


def test_time_window(spark):
    p = preds(spark, ("Red", "s", 60)).withColumn("arrival_time", F.lit(NOW - 2 * H).cast("timestamp"))
    u = spark.createDataFrame([(NOW,)], "timestamp timestamp")
    a = alerts(spark, ([], [], NOW - 3 * H, NOW), ([], [], NOW - 3 * H, NOW - 2 * H), ([], [], None, None))
    row = summaries.time_window_summary(p, positions(spark, "Red"), u, a, NOW, 1).first()
    assert (row.predictions, row.vehicle_positions, row.trip_updates, row.alerts) == (0, 1, 1, 1)
    assert row.avg_delay == 0.0 and row.start_time == NOW - H


def test_service_summary_counts_high_anomalies(spark):
    p = preds(spark, *[("Red", "s", 0)] * 300, *[("Blue", "s", 3000)] * 6)
    a = alerts(spark, *[(["Red", "Blue"], ["s1"], None, None)] * 11)
    doc = summaries.service_summary(p, a, NOW).first()
    assert doc.high_anomalies == 2 and {x.anomaly_type for x in doc.anomalies} == {"extreme_delays", "service_disruption"}
    assert doc.overall_status == "good" and doc.total_alerts == 11
    quiet = summaries.service_summary(preds(spark, ("Red", "s", 0)), alerts(spark), NOW).first()
    assert (quiet.overall_status, quiet.anomalies) == ("excellent", [])


def test_disruption_names_routes_and_stops(spark):
    few = alerts(spark, *[(["Red"], ["s1"], None, None)] * 10)
    assert rules.service_disruption(few, NOW).collect() == []
    many = alerts(spark, *[(["Red", f"r{i}"], [], None, None) for i in range(11)])
    row = rules.service_disruption(many, NOW).first()
    assert row.description == "High number of active alerts: 11" and len(row.affected_routes) == 12


LOG = ("source_type string, status string, records_processed bigint, records_inserted bigint, "
       "records_failed bigint, started_at timestamp, completed_at timestamp")


def log(spark, *rows):
    return spark.createDataFrame(
        [(s, st, 1, 1, 0, NOW + i * dt.timedelta(seconds=sec), NOW + i * dt.timedelta(seconds=sec))
         for i, (s, st, sec) in enumerate(rows)], LOG)


def test_ingestion_health(spark):
    df = log(spark, *[("a", "error", 1)] * 5, ("b", "error", 1), ("b", "success", 1), ("b", "error", 1))
    rows = {r.source_type: r for r in health.ingestion_health(df).collect()}
    assert (rows["a"].consecutive_failures, rows["a"].status, rows["a"].last_success) == (5, "degraded", None)
    assert (rows["b"].consecutive_failures, rows["b"].status, rows["b"].total_errors) == (1, "healthy", 2)


def test_trailing_minute(spark):
    df = log(spark, *[("a", "success", 20)] * 8)
    got = [r.in_last_minute for r in health.trailing_minute_requests(df).orderBy("started_at").collect()]
    assert got == [1, 2, 3, 3, 3, 3, 3, 3]


def test_freshness_tiers(spark):
    ages = {"a": 299, "b": 300, "c": 899, "d": 900, "e": 901, "f": 1800}
    frames = {k: spark.createDataFrame([(NOW - dt.timedelta(seconds=s),)], "timestamp timestamp") for k, s in ages.items()}
    rows = {r.feed: (r.status, r.is_fresh, r.data_tier) for r in health.feed_freshness(frames, NOW).collect()}
    assert rows == {
        "a": ("fresh", True, "live"), "b": ("stale", True, "may be stale"), "c": ("stale", True, "may be stale"),
        "d": ("old", True, "may be stale"), "e": ("old", False, "may be stale"), "f": ("old", False, "stale")}


def test_enrichment_bounds(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    status = [one(enrich.delay_status(F.lit(d).cast("int"))) for d in (None, -5, 0, 1, 300, 301, 900, 901)]
    assert status == ["on_time"] * 3 + ["minor_delay"] * 2 + ["moderate_delay"] * 2 + ["major_delay"]
    accuracy = [one(enrich.prediction_accuracy(F.lit(d).cast("int"))) for d in (None, -59, 60, -299, 300)]
    assert accuracy == ["unknown", "high", "medium", "medium", "low"]
    speed = [one(enrich.speed_category(F.lit(s).cast("double"))) for s in (None, 4.9, 5, 15, 30)]
    assert speed == ["unknown", "stopped", "slow", "normal", "fast"]
    regions = [one(enrich.region_of(F.lit(a), F.lit(b))) for a, b in [
        (42.41, -71.05), (42.29, -71.05), (42.35, -70.9), (42.35, -71.2), (42.4, -71.0)]]
    assert regions == ["North Shore", "South Shore", "East Boston", "West Boston", "Central Boston"]
    colours = [one(enrich.display_colour(F.lit(r), F.lit(c).cast("string"))) for r, c in [
        ("Red", "ABCDEF"), ("Green-B", None), ("Mattapan", None)]]
    assert colours == ["#ABCDEF", "#00843D", "#95a5a6"]
    services = one(enrich.affected_services(F.array(F.lit("Red"), F.lit("CR-X"), F.lit("Blue")), F.array(F.lit("s"))))
    assert services == ["Commuter Rail", "Multiple stops affected", "Subway"]
    empty = F.array().cast("array<string>")
    assert one(enrich.affected_services(empty, empty)) == ["Unknown"]


def test_documents_of_empty_tables(spark):
    p = preds(spark).limit(0)
    row = summaries.delays_with_routes(p).first()
    assert row.delays == summaries.delay_distribution(p).first() and row.problem_routes == {}
    v = spark.createDataFrame([], "vehicle_id string, timestamp timestamp")
    assert tuple(summaries.vehicles_with_hours(v).first()) == (0, [0] * 24)


def test_hours_of_vehicles(spark):
    rows = [("a", NOW), ("a", NOW + H), ("b", NOW), ("b", None), ("c", None), (None, NOW)]
    v = spark.createDataFrame(rows, "vehicle_id string, timestamp timestamp")
    row = summaries.vehicles_with_hours(v).first()
    assert row.active_vehicles == 3
    assert row.hourly_vehicle_counts == [r.vehicles for r in summaries.vehicles_by_hour_of_day(v).orderBy("hour").collect()]


def test_latest_stats(spark):
    tables = {
        "predictions": preds(spark, ("Red", "s", 121), ("Red", "s", 120), ("Blue", "s", 1000)),
        "vehicle_positions": spark.createDataFrame(
            [(1, "v", "Red", 42.0, -71.0, NOW - H), (2, "v", "Blue", 42.1, -71.1, NOW)],
            "id bigint, vehicle_id string, route_id string, latitude double, longitude double, timestamp timestamp"),
        "routes": spark.createDataFrame([("Red", "Red Line", 1, "DA291C")],
                                        "id string, route_name string, route_type int, route_color string"),
        "alerts": alerts(spark, (["Red"], [], None, None)).withColumns(
            {"alert_header_text": F.lit("h"), "alert_effect": F.lit("DELAY")}),
    }
    docs = summaries.latest_stats(tables.__getitem__, NOW)
    row = docs["totals"].first()
    assert (row.total_routes, row.active_vehicles, row.active_alerts) == (1, 1, 1)
    assert row.delays.total_delays == 2 and row.problem_routes == {"Red": 1, "Blue": 1}
    assert len(row.hourly_vehicle_counts) == 24 and row.hourly_vehicle_counts[12] == 1
    assert [tuple(r) for r in docs["vehicle_locations"].collect()] == [("Blue", 42.1, -71.1)]
