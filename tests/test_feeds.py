"""Hand-written feed documents with known answers."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tramline.functions import codes
from tramline.operators import flatten
from tramline.schemas import DOCUMENTS
from tramline.sources import feeds


def lines(spark, *docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string")


def test_rest_prediction_paths_may_be_missing(spark):
    full = {
        "id": "p1", "type": "prediction",
        "attributes": {
            "arrival_time": "2024-03-01T07:00:00-05:00", "departure_time": "2024-03-01T12:01:00Z",
            "status": "Stopped", "delay": 30, "vehicle": {"id": "v1", "label": "1701"}},
        "relationships": {"stop": {"data": {"id": "s"}}, "trip": {"data": {"id": "t"}}, "route": {"data": None}}}
    bare = {"id": "p2", "type": "prediction"}
    raw = feeds.rest_records(lines(spark, full, bare))
    a, b = flatten.rest_predictions(raw).orderBy("prediction_id").collect()
    assert a.arrival_time == dt.datetime(2024, 3, 1, 12) and a.departure_time == dt.datetime(2024, 3, 1, 12, 1)
    assert (a.stop_id, a.trip_id, a.route_id, a.vehicle_label, a.delay) == ("s", "t", None, "1701", 30)
    assert b.prediction_id == "p2" and b.stop_id is None and b.arrival_time is None


def test_a_bad_line_does_not_stop_the_rest(spark):
    text = lines(spark, {"id": "1", "type": "vehicle"}, '{"id": ', {"id": "2", "type": "prediction"}, "[]")
    decoded = feeds.decode(text, DOCUMENTS["rest"])
    assert feeds.documents(decoded).count() + feeds.undecodable(decoded).count() == 4
    assert feeds.undecodable(decoded).where("corrupt LIKE '{%'").count() == 1


MESSAGE = {
    "header": {"gtfs_realtime_version": "2.0", "timestamp": 1709294400},
    "entity": [
        {"id": "e1", "vehicle": {
            "trip": {"trip_id": "t1", "route_id": "Red"}, "position": {"latitude": 42.3, "longitude": -71.0},
            "timestamp": 1709294390}},
        {"id": "e2", "trip_update": {
            "trip": {"trip_id": "t2", "route_id": "Blue"}, "vehicle": {"id": "v2"},
            "stop_time_update": [
                {"stop_id": "a", "stop_sequence": 1, "arrival": {"delay": 60}, "departure": {"delay": 0}},
                {"stop_id": "b", "arrival": {"time": 1709294500}, "departure": {"delay": 120}},
                {"stop_id": "c"}]}},
        {"id": "e3", "trip_update": {"stop_time_update": [{"stop_id": "a", "arrival": {"delay": 0}}]}},
        {"id": "e4", "alert": {
            "active_period": [{"start": 100, "end": 200}, {"start": 300}],
            "informed_entity": [{"route_id": "Red"}, {"stop_id": "s1", "trip": {"trip_id": "t9"}}, {}],
            "header_text": {"translation": [
                {"text": "salut", "language": "fr"}, {"text": "hello", "language": "en"},
                {"text": "again", "language": "en"}]}}},
    ],
}


def test_feed_message(spark):
    entities = flatten.feed_entities(feeds.feed_messages(lines(spark, MESSAGE)))
    assert [r.entity for r in flatten.entity_kinds(entities.coalesce(1)).collect()] == [
        "vehicle", "trip_update", "trip_update", "alert"]
    [v] = flatten.feed_positions(entities).collect()
    assert (v.vehicle_id, v.trip_id, v.bearing) == ("e1", "t1", None)
    assert v.timestamp == dt.datetime(2024, 3, 1, 11, 59, 50) and v.feed_timestamp == dt.datetime(2024, 3, 1, 12)
    u, none = flatten.feed_trip_updates(entities).orderBy(F.desc_nulls_last("delay")).collect()
    assert (u.trip_id, u.vehicle_id, u.delay, len(u.stop_time_updates)) == ("t2", "v2", 90.0, 3)
    assert u.timestamp == dt.datetime(2024, 3, 1, 12)
    assert (none.trip_id, none.delay) == ("e3", None)
    [a] = flatten.feed_alerts(entities).collect()
    assert a.effective_start_date == dt.datetime(1970, 1, 1, 0, 5)
    assert a.effective_end_date == dt.datetime(1970, 1, 1, 0, 3, 20)
    assert (a.affected_routes, a.affected_stops, a.affected_trips) == (["Red"], ["s1"], ["t9"])
    assert (a.alert_header_text, a.alert_description_text) == ("hello", None)


def test_loose_records(spark):
    docs = [
        {"prediction_id": "p", "trip_id": "t", "route_id": "r", "stop_id": "s", "arrival_time": "1709294400"},
        {"trip_id": "t", "route_id": "r", "stop_time_updates": []},
        {"vehicle_id": "v", "latitude": 1.0, "longitude": 2.0, "trip_id": "t", "route_id": "r",
         "timestamp": "2024-03-01T12:00:00Z"},
        {"alert_header_text": "x", "severity_level": "INFO"},
        {"stop_id": "s", "stop_name": "n"}, {"route_id": "r", "route_name": "n", "route_type": 1},
        {"trip_id": "t", "route_id": "r"}, {"vehicle_id": "v"}, {"record_type": "trip", "trip_id": "t"}]
    loose = flatten.record_type(feeds.documents(feeds.decode(lines(spark, *docs), DOCUMENTS["loose"]))).coalesce(1)
    assert [r.record_type for r in loose.collect()] == [
        "prediction", "trip_update", "vehicle_position", "alert", "stop", "route", "trip", None, "trip"]
    assert flatten.untyped(loose).count() == 1
    assert flatten.typed_records(loose, "prediction").first().arrival_time == dt.datetime(2024, 3, 1, 12)
    alert = flatten.typed_records(loose, "alert").first()
    assert (alert.alert_id, alert.alert_severity_level, alert.affected_routes) == ("unknown", "INFO", [])
    assert flatten.typed_records(loose, "trip_update").first().stop_time_updates == []


def test_times(spark):
    text = ["2024-03-01T12:00:00Z", "2024-03-01T07:00:00-05:00", "1709294400", "1709294400.5",
            "noon", "", None, "2024-13-01T00:00:00Z", "2024-03-01"]
    df = spark.createDataFrame([(t,) for t in text], "t string").coalesce(1)
    noon = dt.datetime(2024, 3, 1, 12)
    got = [r[0] for r in df.select(codes.parse_time(F.col("t"))).collect()]
    assert got == [noon, noon, noon, noon + dt.timedelta(seconds=0.5), None, None, None, None,
                   dt.datetime(2024, 3, 1)]
    assert spark.range(1).select(codes.parse_time(F.lit(1709294400))).first()[0] == noon


def test_codes(spark):
    one = lambda value, table: spark.range(1).select(codes.to_code(F.lit(value), table)).first()[0]
    assert one("scheduled", codes.SCHEDULE_RELATIONSHIP) == 0
    assert one("SKIPPED", codes.SCHEDULE_RELATIONSHIP) == 4
    assert one("low", codes.CONGESTION_LEVEL) == 1
    assert one("many_seats_available", codes.OCCUPANCY_STATUS) == 1
    assert one("9", codes.OCCUPANCY_STATUS) == 9
    assert one(3, codes.CONGESTION_LEVEL) == 3
    assert one("none such", codes.CONGESTION_LEVEL) is None


def test_generic_messages(spark):
    schema = "id string, trip struct<schedule_relationship: int>, updates array<struct<trip: struct<schedule_relationship: bigint>, more: array<int>>>"
    lines = spark.createDataFrame([(x,) for x in (
        '{"id": "a", "trip": {"schedule_relationship": 3}, "updates": [{"trip": {"schedule_relationship": 1}, "more": [0, 1]}, {"trip": null}, null]}',
        '{"id": "b", "trip": {"schedule_relationship": 0}, "updates": []}', '{"id": "c", "trip": {"schedule_relationship": 77}}', "no message", None)],
        "value string")
    got = [r.asDict(recursive=True) for r in feeds.generic_messages(lines, schema).collect()]
    assert got[0] == {"id": "a", "trip": {"schedule_relationship": "CANCELED"}, "updates": [
        {"trip": {"schedule_relationship": "ADDED"}, "more": [0, 1]}, {"trip": None, "more": None}, None]}
    assert got[1] == {"id": "b", "trip": {"schedule_relationship": None}, "updates": []}
    assert got[2] == {"id": "c", "trip": {"schedule_relationship": None}, "updates": None}
    assert all(x == {"id": None, "trip": None, "updates": None} for x in got[3:])
