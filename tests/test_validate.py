"""Each rule on, just inside and just outside its bound."""

import datetime as dt

import pytest

from tramline.operators import validate as v
from tramline.schemas import RECORDS

NOW = dt.datetime(2024, 3, 1, 12)
S, MIN, H, US = (dt.timedelta(**{k: 1}) for k in ("seconds", "minutes", "hours", "microseconds"))

GOOD = {
    "stop": {"stop_id": "1", "stop_name": "Park"},
    "route": {"route_id": "Red", "route_name": "Red Line", "route_type": 1},
    "trip": {"trip_id": "t", "route_id": "Red"},
    "prediction": {"prediction_id": "p", "trip_id": "t", "stop_id": "s", "route_id": "Red"},
    "vehicle_position": {"vehicle_id": "v", "latitude": 42.3, "longitude": -71.0, "timestamp": NOW},
    "trip_update": {"trip_id": "t", "timestamp": NOW},
    "alert": {"alert_id": "a"},
}

CASES = [
    ("stop", {}, []),
    ("stop", {"stop_lat": 42.0, "stop_lon": -71.5}, []),
    ("stop", {"stop_lat": 43.0, "stop_lon": -70.5}, []),
    ("stop", {"stop_lat": 41.999, "stop_lon": -71.0}, ["outside_area"]),
    ("stop", {"stop_lat": 42.5, "stop_lon": -70.499}, ["outside_area"]),
    ("stop", {"stop_lat": 99.0}, []),
    ("stop", {"wheelchair_boarding": 2}, []),
    ("stop", {"wheelchair_boarding": 3}, ["bad_wheelchair_boarding"]),
    ("stop", {"stop_name": "   "}, ["missing_stop_name"]),
    ("stop", {"stop_name": "\t "}, ["missing_stop_name"]),
    ("stop", {"stop_id": None, "wheelchair_boarding": -1}, ["missing_stop_id", "bad_wheelchair_boarding"]),
    ("route", {"route_type": 0}, []),
    ("route", {"route_type": 4}, []),
    ("route", {"route_type": 5}, ["bad_route_type"]),
    ("route", {"route_type": None}, ["missing_route_type"]),
    ("route", {"route_color": "#DA291C"}, []),
    ("route", {"route_color": "##DA291C"}, []),
    ("route", {"route_color": ""}, []),
    ("route", {"route_color": "DA291"}, ["bad_route_color"]),
    ("route", {"route_text_color": "GA291C"}, ["bad_route_text_color"]),
    ("trip", {"direction_id": 0, "bikes_allowed": 2}, []),
    ("trip", {"direction_id": -1}, ["bad_direction_id"]),
    ("trip", {"wheelchair_accessible": 3, "bikes_allowed": 3}, ["bad_wheelchair_accessible", "bad_bikes_allowed"]),
    ("prediction", {"delay": 3600}, []),
    ("prediction", {"delay": -3600}, []),
    ("prediction", {"delay": 3601}, ["delay_out_of_range"]),
    ("prediction", {"delay": -3601}, ["delay_out_of_range"]),
    ("prediction", {"arrival_time": NOW}, ["bad_arrival_time"]),
    ("prediction", {"arrival_time": NOW + US}, []),
    ("prediction", {"arrival_time": NOW + 2 * H}, []),
    ("prediction", {"arrival_time": NOW + 2 * H + US}, ["bad_arrival_time"]),
    ("prediction", {"departure_time": NOW - S}, ["bad_departure_time"]),
    ("vehicle_position", {"speed": 0.0, "bearing": 360.0}, []),
    ("vehicle_position", {"speed": 50.0, "bearing": 0.0}, []),
    ("vehicle_position", {"speed": 50.01}, ["speed_out_of_range"]),
    ("vehicle_position", {"bearing": 360.1}, ["bearing_out_of_range"]),
    ("vehicle_position", {"timestamp": NOW - 30 * MIN}, []),
    ("vehicle_position", {"timestamp": NOW - 30 * MIN - S}, ["too_old"]),
    ("vehicle_position", {"timestamp": NOW + 9 * H}, []),
    ("vehicle_position", {"latitude": 91.0}, ["latitude_out_of_range", "outside_area"]),
    ("vehicle_position", {"longitude": None}, ["missing_longitude"]),
    ("trip_update", {"timestamp": NOW - H}, []),
    ("trip_update", {"timestamp": NOW - H - S}, ["too_old"]),
    ("trip_update", {"delay": -3601.0}, ["delay_out_of_range"]),
    ("alert", {"effective_start_date": NOW, "effective_end_date": NOW}, ["bad_period"]),
    ("alert", {"effective_start_date": NOW, "effective_end_date": NOW + S}, []),
    ("alert", {"effective_end_date": NOW}, []),
    ("alert", {"alert_severity_level": ""}, []),
    ("alert", {"alert_severity_level": "SEVERE"}, []),
    ("alert", {"alert_severity_level": "severe"}, ["bad_severity"]),
]


def frame(spark, kind, rows):
    fields = [f.name for f in RECORDS[kind]]
    return spark.createDataFrame([tuple({**GOOD[kind], **r}.get(f) for f in fields) for r in rows], RECORDS[kind])


@pytest.mark.parametrize("kind", list(GOOD))
def test_rules(spark, kind):
    cases = [(row, want) for k, row, want in CASES if k == kind]
    checked = v.validate(frame(spark, kind, [r for r, _ in cases]).coalesce(1), kind, NOW)
    got = [r[v.REASONS] for r in checked.collect()]
    assert got == [want for _, want in cases]


def test_good_and_rejected_cover_the_input(spark):
    cases = [row for k, row, _ in CASES if k == "prediction"]
    checked = v.validate(frame(spark, "prediction", cases), "prediction", NOW)
    assert v.valid(checked).count() + v.rejected(checked).count() == len(cases)
    assert v.REASONS not in v.valid(checked).columns


def test_alert_options(spark):
    old = {"effective_start_date": NOW - dt.timedelta(days=8), "alert_severity_level": "high"}
    df = frame(spark, "alert", [old])
    assert v.validate(df, "alert", NOW).first()[v.REASONS] == ["bad_severity"]
    checked = v.validate(df, "alert", NOW, severities=("high",), alert_age=dt.timedelta(days=7))
    assert checked.first()[v.REASONS] == ["too_old"]


def test_scores(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.01)], "alert_id string, confidence_score double")
    full = df.selectExpr(
        "*", "cast(null as timestamp) effective_start_date", "cast(null as timestamp) effective_end_date",
        "cast(null as string) alert_severity_level")
    reasons = {r.alert_id: r[v.REASONS] for r in v.validate(full, "alert", NOW).collect()}
    assert reasons == {"a": [], "b": ["confidence_score_out_of_range"]}


def test_stats_of_nothing(spark):
    checked = v.validate(frame(spark, "stop", []), "stop", NOW).selectExpr("'stop' AS record_type", "*")
    assert v.validation_stats(checked).collect() == []
