"""The test views as SQL, and a helper that puts the needed ones before a query."""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def code(n: str) -> str:
    return (
        f"CASE WHEN {n}=3 THEN 'Red' WHEN {n}=8 THEN 'Blue' WHEN {n}=13 THEN 'Orange' "
        f"WHEN {n}%5=0 THEN 'CR-'||({n})::VARCHAR WHEN {n}%5=1 THEN 'Green-'||({n})::VARCHAR "
        f"WHEN {n}%5=2 THEN 'SL'||({n})::VARCHAR ELSE ({n})::VARCHAR END")


def r2(x: str) -> str:
    return (
        f"(CASE WHEN ({x}) < 0 THEN -CAST(floor(0.5::DOUBLE - ({x})*100.0::DOUBLE) AS BIGINT) "
        f"ELSE CAST(floor(({x})*100.0::DOUBLE + 0.5::DOUBLE) AS BIGINT) END / 100.0::DOUBLE)")


def div(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))"


def pct(a: str, b: str) -> str:
    return r2(div(f"({a})*100.0::DOUBLE", b))


def mins(s: str, n: str) -> str:
    return r2(div(s, f"({n})*60.0::DOUBLE"))


LATE = "count(*) FILTER (delay > 0)"
POS = "CASE WHEN delay > 0 THEN delay ELSE 0 END"

_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)"

VIEWS = {
    "v_routes": f"""
        SELECT {code('n_nationkey')} AS id, n_name AS route_name, n_regionkey AS route_type,
               lpad((n_nationkey*40009)::VARCHAR, 6, '0') AS route_color
        FROM nation""",
    "v_stops": """
        SELECT 'S'||s_suppkey::VARCHAR AS id, s_name AS stop_name,
               CASE WHEN s_suppkey%17<>16 THEN (42305+10*(s_suppkey%10))/1000.0::DOUBLE END AS stop_lat,
               CASE WHEN s_suppkey%17<>16 THEN -(71075-10*((s_suppkey//10)%8))/1000.0::DOUBLE END AS stop_lon,
               (s_suppkey%4)::INTEGER AS wheelchair_boarding
        FROM supplier""",
    "v_trips": f"""
        SELECT DISTINCT 'T'||user_id::VARCHAR AS id, {code('(user_id%24)')} AS route_id,
               'weekday' AS service_id, (user_id%2)::INTEGER AS direction_id
        FROM events""",
    "v_vehicles": """
        SELECT DISTINCT 'V'||(event_id%50)::VARCHAR AS id, 'V'||(event_id%50)::VARCHAR AS vehicle_id,
               'Vehicle '||(event_id%50)::VARCHAR AS vehicle_label
        FROM events""",
    "v_predictions": f"""
        SELECT event_id AS id, 'P'||event_id::VARCHAR AS prediction_id, 'T'||user_id::VARCHAR AS trip_id,
               CASE WHEN event_id%97=0 THEN 'X-99' ELSE {code('(user_id%24)')} END AS route_id,
               'S'||{_K}::VARCHAR AS stop_id, 'V'||(event_id%50)::VARCHAR AS vehicle_id,
               CASE WHEN event_type<>'error' THEN (floor(value*12)-300)::INTEGER END AS delay,
               CASE WHEN event_id%13<>0 THEN ts + to_minutes(event_id%140-10) END AS arrival_time,
               CASE WHEN event_id%13<>0 THEN ts + to_minutes(event_id%140-8) END AS departure_time,
               CASE event_id%4 WHEN 0 THEN 'scheduled' WHEN 1 THEN 'ADDED' WHEN 2 THEN 'canceled'
                    ELSE 'bogus' END AS schedule_relationship,
               ts AS timestamp
        FROM events""",
    "v_vehicle_positions": f"""
        SELECT event_id AS id, 'V'||(event_id%50)::VARCHAR AS vehicle_id, 'T'||user_id::VARCHAR AS trip_id,
               CASE WHEN event_id%97=0 THEN 'X-99' ELSE {code('(user_id%24)')} END AS route_id,
               (event_id%2)::INTEGER AS direction_id,
               (42305+event_id%100)/1000.0::DOUBLE AS latitude,
               -(71075-event_id%80)/1000.0::DOUBLE AS longitude,
               CASE WHEN event_id%19<>0 THEN (event_id*7)%6000 END AS speed_cms,
               CASE WHEN event_id%19<>0 THEN ((event_id*7)%6000)/100.0::DOUBLE END AS speed,
               (event_id%400)::DOUBLE AS bearing,
               CASE WHEN event_type<>'view' THEN (event_id%4)::INTEGER END AS congestion_level,
               ts AS timestamp, ts + to_minutes(event_id%45-3) AS received_at
        FROM events""",
    "v_alerts": f"""
        SELECT 'A'||event_id::VARCHAR AS alert_id, 'Notice '||event_id::VARCHAR AS alert_header_text,
               CASE {_K}%4 WHEN 0 THEN 'DETOUR' WHEN 1 THEN 'DELAY' WHEN 2 THEN 'NO_SERVICE'
                    ELSE 'OTHER' END AS alert_effect,
               CASE event_id%5 WHEN 0 THEN 'INFO' WHEN 1 THEN 'WARNING' WHEN 2 THEN 'SEVERE'
                    WHEN 3 THEN 'high' END AS alert_severity_level,
               CASE WHEN event_id%2=1 THEN [{code('(user_id%24)')}, {code('((user_id+1)%24)')}]
                    ELSE [{code('(user_id%24)')}] END AS affected_route_ids,
               CASE WHEN {_K}%3=0 THEN []::VARCHAR[] ELSE ['S'||{_K}::VARCHAR] END AS affected_stop_ids,
               ts AS active_period_start,
               CASE WHEN event_id%11<>0 THEN ts + to_hours(event_id%72-6) END AS active_period_end,
               ts AS timestamp
        FROM events WHERE event_type='error'""",
    "v_trip_updates": f"""
        SELECT 'T'||l_orderkey::VARCHAR AS trip_id, 'V'||(l_suppkey%50)::VARCHAR AS vehicle_id,
               {code('(l_suppkey%24)')} AS route_id, l_shipdate AS timestamp,
               l_shipdate + to_minutes(l_orderkey%90) AS received_at,
               list_transform(range(1, l_linenumber+1), lambda i: 'S'||(l_suppkey+i)::VARCHAR) AS stop_ids,
               list_transform(range(1, l_linenumber+1),
                   lambda i: CASE WHEN i%4=3 THEN l_quantity::INTEGER*25-400 END) AS element_delays,
               list_transform(range(1, l_linenumber+1),
                   lambda i: l_quantity::INTEGER*20-300+30*(i%3)) AS arrival_delays,
               list_transform(range(1, l_linenumber+1),
                   lambda i: CASE WHEN l_returnflag<>'N' THEN l_quantity::INTEGER*20-290+30*(i%3) END)
                   AS departure_delays
        FROM lineitem""",
}


def sql(body: str, **ctes: str) -> str:
    """``body`` after the views it names, the given extra CTEs between them."""
    text = body + " ".join(ctes.values())
    needed = [v for v in VIEWS if re.search(rf"\b{v}\b", text)]
    parts = [f"{v} AS ({VIEWS[v]})" for v in needed] + [f"{n} AS ({q})" for n, q in ctes.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def window(view: str, hours: float = 720) -> str:
    return f"(SELECT * FROM {view} WHERE timestamp >= {AS_OF} - INTERVAL '{hours} hours')"


def spine(hours: int = 720) -> str:
    return (
        f"SELECT unnest(generate_series(date_trunc('hour', {AS_OF} - INTERVAL '{hours} hours'), "
        f"date_trunc('hour', {AS_OF}), INTERVAL '1 hour')) AS hour_bucket")
