"""Explicit schemas: typed records, stored tables and nested feed documents."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import types as T


class Schemas(Mapping):
    """Named schemas kept as DDL and parsed on first use, which needs a running session."""

    def __init__(self, ddl: dict[str, str]):
        self._ddl = ddl
        self._parsed: dict[str, T.StructType] = {}

    def __getitem__(self, name: str) -> T.StructType:
        if name not in self._parsed:
            self._parsed[name] = T.StructType.fromDDL(self._ddl[name])
        return self._parsed[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._ddl)

    def __len__(self) -> int:
        return len(self._ddl)


STOP_EVENT_DDL = (
    "struct<stop_id:string,stop_sequence:int,delay:int,"
    "arrival:struct<delay:int,time:bigint>,departure:struct<delay:int,time:bigint>>"
)

# Typed records, as they leave the projections and enter validation.
RECORDS = Schemas({
    "stop": (
        "stop_id string, stop_name string, stop_lat double, stop_lon double, "
        "wheelchair_boarding int, platform_code string"),
    "route": (
        "route_id string, route_name string, route_type int, route_color string, "
        "route_text_color string"),
    "trip": (
        "trip_id string, route_id string, service_id string, trip_headsign string, "
        "trip_short_name string, direction_id int, block_id string, shape_id string, "
        "wheelchair_accessible int, bikes_allowed int"),
    "prediction": (
        "prediction_id string, trip_id string, stop_id string, route_id string, "
        "arrival_time timestamp, departure_time timestamp, schedule_relationship string, "
        "vehicle_id string, vehicle_label string, status string, delay int"),
    "vehicle_position": (
        "vehicle_id string, trip_id string, route_id string, latitude double, longitude double, "
        "bearing double, speed double, current_status string, timestamp timestamp, "
        "congestion_level string, occupancy_status string"),
    "trip_update": (
        "trip_id string, vehicle_id string, route_id string, timestamp timestamp, delay double, "
        f"stop_time_updates array<{STOP_EVENT_DDL}>"),
    "alert": (
        "alert_id string, alert_header_text string, alert_description_text string, "
        "alert_url string, effective_start_date timestamp, effective_end_date timestamp, "
        "affected_routes array<string>, affected_stops array<string>, "
        "affected_trips array<string>, alert_severity_level string, cause string, effect string"),
})

# Stored tables. Facts end in the columns their folders are named by: the day of
# ``timestamp``, which time windows prune by, and for predictions also the day of
# arrival, which is part of their key and prunes the search for known keys.
TABLES = Schemas({
    "routes": (
        "id string, route_name string, route_type int, route_color string, "
        "route_text_color string, route_sort_order int, route_long_name string, route_desc string"),
    "stops": (
        "id string, stop_name string, stop_lat double, stop_lon double, "
        "wheelchair_boarding int, platform_code string, parent_station string"),
    "trips": (
        "id string, route_id string, service_id string, trip_headsign string, "
        "trip_short_name string, direction_id int, block_id string, shape_id string, "
        "wheelchair_accessible int, bikes_allowed int"),
    "vehicles": ("id string, vehicle_id string, vehicle_label string"),
    "predictions": (
        "id string, trip_id string, route_id string, stop_id string, vehicle_id string, "
        "arrival_time timestamp, departure_time timestamp, schedule_relationship int, "
        "status string, delay int, timestamp timestamp, source string, processed_at timestamp, batch_id string, "
        "partition_date string, arrival_date string"),
    "vehicle_positions": (
        "id string, vehicle_id string, trip_id string, route_id string, direction_id int, "
        "stop_id string, latitude double, longitude double, bearing double, speed double, "
        "congestion_level int, occupancy_status int, timestamp timestamp, source string, processed_at timestamp, "
        "batch_id string, partition_date string"),
    "trip_updates": (
        "id string, trip_id string, route_id string, delay double, start_time timestamp, "
        "end_time timestamp, timestamp timestamp, source string, processed_at timestamp, batch_id string, "
        "partition_date string"),
    "alerts": (
        "alert_id string, alert_header_text string, alert_description_text string, "
        "alert_url string, alert_effect string, alert_severity_level string, "
        "affected_route_ids array<string>, affected_stop_ids array<string>, "
        "affected_trip_ids array<string>, active_period_start timestamp, "
        "active_period_end timestamp, timestamp timestamp, source string, processed_at timestamp, batch_id string, "
        "partition_date string"),
    "data_ingestion_logs": (
        "source_type string, status string, records_processed bigint, records_inserted bigint, "
        "records_updated bigint, records_failed bigint, processing_time_ms bigint, "
        "error_message string, started_at timestamp, completed_at timestamp, batch_id string, partition_date string"),
    "quarantine": (
        "kind string, reject_reasons array<string>, payload string, batch_id string, partition_date string"),
    "delay_summary": (
        "hour_bucket timestamp, route_id string, n bigint, late bigint, severe bigint, late_s bigint, "
        "late_squares decimal(38,0), delay_s bigint, known bigint, worst int, batch_id string, partition_date string"),
})

PARTITION_COLUMNS = {
    "predictions": ["arrival_date", "partition_date"],
    "vehicle_positions": ["partition_date"],
    "trip_updates": ["partition_date"],
    "alerts": ["partition_date"],
    "data_ingestion_logs": ["partition_date"],
    "quarantine": ["partition_date"],
    "delay_summary": ["partition_date"],
}

_REF = "struct<data:struct<id:string>>"

# One JSON:API record per line. Predictions, vehicles and routes share the
# envelope, so a mixed feed is read once with the union of their attributes.
_RESOURCE_DDL = (
    "id string, type string, "
    "attributes struct<"
    "arrival_time:string,departure_time:string,schedule_relationship:string,status:string,"
    "delay:double,vehicle:struct<id:string,label:string>,"
    "latitude:double,longitude:double,bearing:double,speed:double,current_status:string,"
    "updated_at:string,congestion_level:string,occupancy_status:string,trip:struct<id:string>,"
    "long_name:string,type:int,color:string,text_color:string>, "
    f"relationships struct<stop:{_REF},trip:{_REF},route:{_REF}>")

# A response document holds its records in ``data``.
_REST_DDL = f"{_RESOURCE_DDL}, data array<struct<{_RESOURCE_DDL}>>"

_TEXT = "struct<translation:array<struct<text:string,language:string>>>"

_FEED_DDL = (
    "header struct<gtfs_realtime_version:string,timestamp:bigint>, "
    "entity array<struct<id:string,"
    "vehicle:struct<trip:struct<trip_id:string,route_id:string>,vehicle:struct<id:string,label:string>,"
    "position:struct<latitude:double,longitude:double,bearing:double,speed:double>,"
    "current_status:string,timestamp:bigint,congestion_level:string,occupancy_status:string>,"
    "trip_update:struct<trip:struct<trip_id:string,route_id:string>,vehicle:struct<id:string>,"
    f"stop_time_update:array<{STOP_EVENT_DDL}>>,"
    "alert:struct<active_period:array<struct<start:bigint,end:bigint>>,"
    "informed_entity:array<struct<route_id:string,stop_id:string,trip:struct<trip_id:string>>>,"
    f"header_text:{_TEXT},description_text:{_TEXT},"
    "url:struct<translation:array<struct<text:string,language:string>>>,"
    "severity_level:string,cause:string,effect:string>>>")

# Untyped records as loose key/value documents: times are text and every field
# is optional; the record type is worked out from the fields present.
_LOOSE_DDL = (
    "record_type string, prediction_id string, trip_id string, stop_id string, stop_name string, "
    "stop_lat double, stop_lon double, wheelchair_boarding int, platform_code string, "
    "route_id string, route_name string, route_type int, route_color string, "
    "route_text_color string, service_id string, trip_headsign string, trip_short_name string, "
    "direction_id int, block_id string, shape_id string, wheelchair_accessible int, "
    "bikes_allowed int, arrival_time string, departure_time string, "
    "schedule_relationship string, vehicle_id string, vehicle_label string, status string, "
    "delay double, latitude double, longitude double, bearing double, speed double, "
    "current_status string, timestamp string, congestion_level string, occupancy_status string, "
    f"stop_time_updates array<{STOP_EVENT_DDL}>, id string, alert_id string, "
    "alert_header_text string, header_text string, alert_description_text string, "
    "description_text string, alert_url string, url string, effective_start_date string, "
    "effective_end_date string, affected_routes array<string>, affected_stops array<string>, "
    "affected_trips array<string>, alert_severity_level string, severity_level string, "
    "cause string, effect string")

DOCUMENTS = Schemas({"rest": _REST_DDL, "feed": _FEED_DDL, "loose": _LOOSE_DDL})
