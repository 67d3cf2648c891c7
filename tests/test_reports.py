"""Edge cases of the reports: empty windows, one row, unknown delays, ties and hot lines."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tramline.functions.measures import r2
from tramline.operators.headway import headway_moments
from tramline.plans import analytics

NOON = dt.datetime(2024, 3, 1, 12, 30)
MIN = dt.timedelta(minutes=1)
P = "id bigint, route_id string, trip_id string, stop_id string, delay int, timestamp timestamp"
V = ("id bigint, vehicle_id string, route_id string, direction_id int, speed double, "
     "congestion_level int, timestamp timestamp")


def routes(spark):
    return spark.createDataFrame(
        [("Red", "Red Line", 1), ("Blue", "Blue Line", 1)], "id string, route_name string, route_type int")


def preds(spark, *rows):
    return spark.createDataFrame(
        [(i, r, "t", "s", d, NOON - m * MIN) for i, (r, d, m) in enumerate(rows)], P)


def test_rounding(spark):
    values = [0.125, -0.125, 2.675, 1.005, -0.001, 0.0, 33.333, None]
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    got = [r[0] for r in df.select(r2(F.col("v"))).collect()]
    assert got[:2] == [0.13, -0.13] and got[4:] == [0.0, 0.0, 33.33, None]
    assert str(got[4]) == "0.0"


def test_performance_counts_unknown_delay_as_on_time(spark):
    df = preds(spark, ("Red", None, 1), ("Red", 120, 2), ("Red", -60, 3), ("gone", 5, 1), ("Red", 9, 60 * 25))
    [row] = analytics.performance(df, routes(spark), NOON).collect()
    assert (row.total_predictions, row.delayed_predictions, row.on_time_percentage) == (3, 1, 66.67)
    assert row.avg_delay_minutes == 0.67 and row.overall_avg_delay_minutes == 0.5
    assert row.delay_std_dev_minutes == round(statistics.stdev([0, 120, 0]) / 60, 2)


def test_performance_of_one_row_and_of_nothing(spark):
    [row] = analytics.performance(preds(spark, ("Red", 60, 1)), routes(spark), NOON).collect()
    assert row.delay_std_dev_minutes is None
    assert analytics.performance(preds(spark), routes(spark), NOON).collect() == []


def test_window_bound_is_inclusive(spark):
    df = preds(spark, ("Red", 60, 60), ("Red", 60, 61))
    assert analytics.performance(df, routes(spark), NOON, hours=1).first().total_predictions == 1
    assert analytics.performance(df, routes(spark), NOON, hours=0.5).collect() == []


def test_hour_spine_has_one_more_row_than_hours(spark):
    rows = analytics.delays(preds(spark, ("Red", 60, 31), ("Red", None, 31)), NOON, 24).collect()
    assert len(rows) == 25 and rows[0].hour_bucket == dt.datetime(2024, 2, 29, 12)
    last = rows[-2]
    assert (last.total_predictions, last.delayed_count, last.avg_delay_minutes) == (2, 1, 1.0)
    assert rows[-1].total_predictions == 0 and rows[-1].delay_percentage == 0
    trend = analytics.hourly_trends(preds(spark, ("Red", 60, 31)), NOON, 2).collect()
    assert [r.performance_status for r in trend] == ["No Data", "High Delays", "No Data"]


def test_routes_without_predictions_stay(spark):
    rows = {r.route_id: r for r in analytics.route_comparison(
        preds(spark, ("Red", None, 1)), routes(spark), NOON).collect()}
    assert rows["Blue"].on_time_percentage is None and rows["Blue"].avg_delay_minutes == 0
    assert rows["Blue"].total_predictions == 0 and rows["Blue"].max_delay_minutes is None
    assert rows["Red"].on_time_percentage == 100.0


def test_stop_minutes_are_cut_toward_zero(spark):
    stops = spark.createDataFrame([("s", "Park", 42.36, -71.06)], "id string, stop_name string, stop_lat double, stop_lon double")
    early = preds(spark, *[("Red", -59 - i, 1) for i in range(5)])
    assert analytics.stop_performance(early, stops, NOON).first().max_delay_minutes == 0
    assert analytics.stop_performance(early.limit(4), stops, NOON).collect() == []


def test_peak_follows_the_given_zone(spark):
    one = preds(spark, ("Red", 1, 0))
    assert analytics.peak_periods(one, NOON).first().time_period == "Midday (10 AM-3 PM)"
    assert analytics.peak_periods(one, NOON, tz="America/New_York").first().time_period == "Morning Peak (7-9 AM)"


def test_anomalies_need_spread(spark):
    same = preds(spark, *[("Red", 60, 1)] * 9)
    assert analytics.delay_anomalies(same, NOON).collect() == []
    wide = preds(spark, *[("Red", 60, 1)] * 20, ("Red", 6000, 2), ("Red", None, 1))
    [row] = analytics.delay_anomalies(wide, NOON).collect()
    assert (row.anomaly_type, row["count"], row.max_delay_minutes) == ("Extreme Delay", 1, 100)


def test_vehicle_activity_levels(spark):
    fleet = [(i, f"v{i}", "Red", 0, 1.5 if i else None, i % 2, NOON - (i // 12) * 60 * MIN) for i in range(15)]
    rows = analytics.vehicle_activity(spark.createDataFrame(fleet, V), NOON, 2).collect()
    assert [r.activity_level for r in rows] == ["No Data", "Low Activity", "Normal Activity"]
    assert rows[-1].vehicle_count == 12 and rows[-1].avg_speed_mps == 1.5 and rows[0].avg_speed_mps == 0


def test_realtime_of_nothing(spark):
    v = spark.createDataFrame([], V)
    a = spark.createDataFrame([], "alert_severity_level string, timestamp timestamp")
    rows = {r.data_type: r for r in analytics.realtime(preds(spark), v, a, NOON).collect()}
    assert [rows[k]["count"] for k in ("predictions", "vehicles", "alerts")] == [0, 0, 0]
    assert rows["predictions"].avg_delay_minutes is None


def test_unknown_report(spark):
    with pytest.raises(ValueError):
        analytics.report("nonsense", lambda name: None)


def brute_headways(rows):
    groups = {}
    for route, direction, ts in sorted(rows, key=lambda r: r[2]):
        groups.setdefault((route, direction), []).append(ts)
    out = {}
    for key, times in groups.items():
        gaps = [(b - a).total_seconds() for a, b in zip(times, times[1:])]
        if gaps:
            out[key] = (
                len(gaps), statistics.mean(gaps), statistics.variance(gaps) if len(gaps) > 1 else None,
                min(gaps), max(gaps), sum(g < 180 for g in gaps), sum(g > 900 for g in gaps))
    return out


@pytest.mark.parametrize("slot", [1, 60, 900, 86400])
def test_headways_equal_brute_force(spark, slot):
    pick = random.Random(slot)
    start = dt.datetime(2024, 2, 29, 23)
    rows = [(pick.choice(["Red", "Blue"]), pick.choice([0, 1, None]),
             start + dt.timedelta(seconds=pick.choice([pick.randint(0, 9000), 77, pick.random() * 99])))
            for _ in range(400)]
    rows += [("Hot", 0, start + dt.timedelta(seconds=s)) for s in [0] * 150 + [5] * 50 + [4000]]
    rows += [("One", 0, start), ("Two", 1, start), ("Two", 1, start)]
    df = spark.createDataFrame(rows, "route_id string, direction_id int, timestamp timestamp")
    got = {(r.route_id, r.direction_id): r for r in headway_moments(df, slot_seconds=slot).collect()}
    want = brute_headways([(a, -1 if b is None else b, c) for a, b, c in rows])
    assert {(a, -1 if b is None else b) for a, b in got} == set(want)
    for (route, direction), r in got.items():
        n, mean, variance, least, most, bunched, gaps = want[(route, -1 if direction is None else direction)]
        assert (r.total_headways, r.bunching_incidents, r.gap_incidents) == (n, bunched, gaps)
        assert r.mean_s == pytest.approx(mean) and r.min_s == pytest.approx(least) and r.max_s == pytest.approx(most)
        assert (r.variance_s is None) if variance is None else r.variance_s == pytest.approx(variance, rel=1e-6, abs=1e-6)
