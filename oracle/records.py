"""SQL of validation, enrichment, flattening, inserts, the store and the streams."""

from oracle.analytics import QUERIES as ANALYTICS
from oracle.views import AS_OF, LATE, POS, mins, pct, r2, sql

BOX = (
    "{la} IS NOT NULL AND {lo} IS NOT NULL AND NOT ({la} BETWEEN 42.0::DOUBLE AND 43.0::DOUBLE "
    "AND {lo} BETWEEN -71.5::DOUBLE AND -70.5::DOUBLE)")
AREA = (
    "CASE WHEN {r} LIKE 'CR-%' THEN 'Commuter Rail' WHEN {r} LIKE 'Green-%' THEN 'Green Line' "
    "WHEN {r} IN ('Red', 'Blue', 'Orange') THEN 'Subway' WHEN {r} LIKE 'SL%' THEN 'Silver Line' ELSE 'Bus' END")


def outside(t: str, now: str) -> str:
    return f"NOT ({t} > {now} AND {t} <= {now} + INTERVAL 2 HOURS)"


# Per type: the view, the id, and each rule with the condition that breaks it, in order.
RULES = {
    "stop": ("v_stops", "id", {
        "outside_area": BOX.format(la="stop_lat", lo="stop_lon"),
        "bad_wheelchair_boarding": "wheelchair_boarding NOT IN (0, 1, 2)"}),
    "route": ("v_routes", "id", {
        "bad_route_type": "route_type NOT BETWEEN 0 AND 4",
        "bad_route_color": "NOT regexp_full_match(route_color, '#*[0-9A-Fa-f]{6}')"}),
    "trip": ("v_trips", "id", {"bad_direction_id": "direction_id NOT IN (0, 1)"}),
    "prediction": ("v_predictions", "prediction_id", {
        "delay_out_of_range": "abs(delay) > 3600",
        "bad_arrival_time": outside("arrival_time", "timestamp"),
        "bad_departure_time": outside("departure_time", "timestamp")}),
    "vehicle_position": ("v_vehicle_positions", "vehicle_id", {
        "outside_area": BOX.format(la="latitude", lo="longitude"),
        "speed_out_of_range": "speed_cms > 5000",
        "too_old": "received_at - timestamp > INTERVAL 30 MINUTES",
        "bearing_out_of_range": "bearing > 360"}),
    "trip_update": ("v_trip_updates", "trip_id", {
        "too_old": "received_at - timestamp > INTERVAL 60 MINUTES"}),
    "alert": ("v_alerts", "alert_id", {
        "bad_period": "active_period_start >= active_period_end",
        "bad_severity": "alert_severity_level NOT IN ('INFO', 'WARNING', 'SEVERE')"}),
}


def broken(kind: str) -> str:
    return "concat_ws('|', " + ", ".join(
        f"CASE WHEN {bad} THEN '{name}' END" for name, bad in RULES[kind][2].items()) + ")"


def validation(kind: str) -> str:
    view, key, _ = RULES[kind]
    return (
        f"SELECT record_id, reasons = '' AS is_valid, reasons FROM "
        f"(SELECT {key} AS record_id, {broken(kind)} AS reasons FROM {view})")


ALL_CHECKED = " UNION ALL ".join(
    f"SELECT '{k}' AS record_type, {broken(k)} AS reasons FROM {RULES[k][0]}" for k in RULES)

DELAYS = "list_filter(list_concat(arrival_delays, departure_delays), lambda d: d <> 0)"
MEAN_DELAY = f"list_sum({DELAYS})::DOUBLE / nullif(len({DELAYS}), 0)"
LARGE = "len(list_filter(list_zip(element_delays, arrival_delays), lambda z: abs(coalesce(z[1], z[2])) > 300))"
SIGNIFICANCE = f"CASE WHEN {LARGE} = 0 THEN 'minor' WHEN {LARGE} <= 2 THEN 'moderate' ELSE 'major' END"
SERVICES = (
    "array_to_string(list_sort(list_distinct(list_concat(list_transform(affected_route_ids, "
    f"lambda r: {AREA.format(r='r')}), CASE WHEN len(affected_stop_ids) > 0 "
    "THEN ['Multiple stops affected'] ELSE []::VARCHAR[] END))), '|')")
ROUTES_TEXT = "array_to_string(affected_route_ids, '|') AS affected_routes"
STOPS_TEXT = "array_to_string(affected_stop_ids, '|') AS affected_stops"

ENRICH = {
    "stop": """
        SELECT id AS record_id, CASE WHEN stop_lat IS NOT NULL THEN 'America/New_York' END AS timezone,
               CASE WHEN stop_lat > 42.4::DOUBLE THEN 'North Shore' WHEN stop_lat < 42.3::DOUBLE THEN 'South Shore'
                    WHEN stop_lon > -71.0::DOUBLE THEN 'East Boston'
                    WHEN stop_lon < -71.1::DOUBLE THEN 'West Boston'
                    WHEN stop_lat IS NOT NULL THEN 'Central Boston' END AS geographic_region,
               CASE WHEN stop_lat IS NOT NULL THEN CASE wheelchair_boarding WHEN 1 THEN 'wheelchair_accessible'
                    WHEN 2 THEN 'wheelchair_inaccessible' ELSE '' END END AS accessibility_features
        FROM v_stops""",
    "route": f"""
        SELECT id AS record_id,
               CASE route_type WHEN 0 THEN 'Light Rail' WHEN 1 THEN 'Subway' WHEN 2 THEN 'Commuter Rail'
                    WHEN 3 THEN 'Bus' WHEN 4 THEN 'Ferry' ELSE 'Unknown' END AS route_category,
               {AREA.format(r='id')} AS service_area,
               CASE WHEN id LIKE 'CR-%' THEN 'Peak hours only'
                    WHEN id IN ('Red', 'Blue', 'Orange') THEN 'Every 3-10 minutes'
                    WHEN id LIKE 'Green-%' THEN 'Every 5-15 minutes'
                    ELSE 'Every 10-30 minutes' END AS typical_frequency
        FROM v_routes""",
    "trip": """
        SELECT id AS record_id, CASE WHEN direction_id = 0 THEN 'Outbound' ELSE 'Inbound' END AS direction_name
        FROM v_trips""",
    "prediction": """
        SELECT prediction_id AS record_id,
               CASE WHEN delay IS NULL THEN 'unknown' WHEN abs(delay) < 60 THEN 'high'
                    WHEN abs(delay) < 300 THEN 'medium' ELSE 'low' END AS prediction_accuracy,
               CASE WHEN delay > 900 THEN 'major_delay' WHEN delay > 300 THEN 'moderate_delay'
                    WHEN delay > 0 THEN 'minor_delay' ELSE 'on_time' END AS service_status
        FROM v_predictions""",
    "vehicle_position": f"""
        SELECT vehicle_id AS record_id, 'good' AS location_accuracy,
               CASE WHEN speed_cms IS NULL THEN 'unknown' WHEN speed_cms < 500 THEN 'stopped'
                    WHEN speed_cms < 1500 THEN 'slow' WHEN speed_cms < 3000 THEN 'normal' ELSE 'fast' END
                    AS speed_category,
               {AREA.format(r='route_id')} AS service_area
        FROM v_vehicle_positions""",
    "trip_update": f"""
        SELECT trip_id AS record_id, {SIGNIFICANCE} AS update_significance,
               len(stop_ids) AS affected_stops_count FROM v_trip_updates""",
    "alert": f"""
        SELECT alert_id AS record_id,
               CASE alert_severity_level WHEN 'SEVERE' THEN 'high' WHEN 'WARNING' THEN 'medium' ELSE 'low' END
                    AS alert_priority, {SERVICES} AS affected_services
        FROM v_alerts""",
}

REST_VEHICLE = """
    SELECT vehicle_id, trip_id, route_id, latitude, longitude, bearing, speed,
           NULL::VARCHAR AS current_status, timestamp,
           ['low', 'MEDIUM', 'heavy', 'none'][coalesce(congestion_level, 3) + 1] AS congestion_level,
           NULL::VARCHAR AS occupancy_status
    FROM v_vehicle_positions"""
REST_PREDICTION = """
    SELECT prediction_id, trip_id, stop_id, route_id, arrival_time, departure_time, schedule_relationship,
           vehicle_id, NULL::VARCHAR AS vehicle_label, NULL::VARCHAR AS status, delay
    FROM v_predictions"""

TYPED = {
    "stop": """
        SELECT id AS stop_id, stop_name, stop_lat, stop_lon, wheelchair_boarding,
               NULL::VARCHAR AS platform_code FROM v_stops""",
    "route": """
        SELECT id AS route_id, route_name, route_type, route_color, NULL::VARCHAR AS route_text_color
        FROM v_routes""",
    "trip": """
        SELECT id AS trip_id, route_id, service_id, NULL::VARCHAR AS trip_headsign,
               NULL::VARCHAR AS trip_short_name, direction_id, NULL::VARCHAR AS block_id,
               NULL::VARCHAR AS shape_id, NULL::INTEGER AS wheelchair_accessible,
               NULL::INTEGER AS bikes_allowed FROM v_trips""",
    "prediction": REST_PREDICTION,
    "vehicle_position": """
        SELECT vehicle_id, trip_id, route_id, latitude, longitude, bearing, speed,
               NULL::VARCHAR AS current_status, timestamp,
               congestion_level::VARCHAR AS congestion_level, NULL::VARCHAR AS occupancy_status
        FROM v_vehicle_positions""",
    "trip_update": f"""
        SELECT trip_id, vehicle_id, route_id, timestamp, {MEAN_DELAY} AS delay,
               len(stop_ids) AS stop_time_updates FROM v_trip_updates""",
    "alert": f"""
        SELECT alert_id, alert_header_text, NULL::VARCHAR AS alert_description_text,
               NULL::VARCHAR AS alert_url, active_period_start AS effective_start_date,
               active_period_end AS effective_end_date, {ROUTES_TEXT}, {STOPS_TEXT}, '' AS affected_trips,
               alert_severity_level, NULL::VARCHAR AS cause, alert_effect AS effect FROM v_alerts""",
}

FIRST = (
    "SELECT id, trip_id, stop_id, arrival_time, delay, timestamp FROM v_predictions QUALIFY row_number() "
    "OVER (PARTITION BY trip_id, stop_id, arrival_time ORDER BY timestamp, id) = 1")
MID = "TIMESTAMP '2024-01-16 00:00:00'"
SEED_NAMES = (
    "('Red', 'Red Line'), ('Orange', 'Orange Line'), ('Blue', 'Blue Line'), ('Green-B', 'Green Line B'), "
    "('Green-C', 'Green Line C'), ('Green-D', 'Green Line D'), ('Green-E', 'Green Line E'), "
    "('CR-Fairmount', 'Fairmount Line')")
SEEDS = "('Red'), ('Orange'), ('Blue'), ('Green-B'), ('Green-C'), ('Green-D'), ('Green-E'), ('CR-Fairmount')"

MESSAGES = """
    SELECT 'transit.predictions.raw' AS topic, trip_id AS key, route_id FROM v_predictions
    UNION ALL SELECT 'transit.vehicles.raw', vehicle_id, route_id FROM v_vehicle_positions
    UNION ALL SELECT 'transit.alerts.raw', alert_id, NULL FROM v_alerts
    UNION ALL SELECT 'transit.trip_updates.raw', trip_id, route_id FROM v_trip_updates"""

# The clock of the ingested stream, and what its rules let through.
CLOCK = "TIMESTAMP '2024-01-30 12:00:00'"
GOOD_PREDICTION = (
    f"NOT coalesce(abs(delay) > 3600 OR {outside('arrival_time', CLOCK)} "
    f"OR {outside('departure_time', CLOCK)}, false)")
GOOD_POSITION = (
    f"NOT coalesce(speed_cms > 5000, false) AND bearing <= 360 AND timestamp >= {CLOCK} - INTERVAL 30 MINUTES")


QUERIES = {
    **{f"validate_{k}": sql(validation(k)) for k in RULES},
    "validation_stats": sql(f"""
        SELECT record_type, count(*) AS processed, count(*) FILTER (reasons <> '') AS errors,
               {pct("count(*) FILTER (reasons = '')", 'count(*)')} AS success_rate
        FROM ({ALL_CHECKED}) GROUP BY record_type"""),
    "rejected_by_rule": sql(f"""
        SELECT record_type, rule, count(*) AS records
        FROM (SELECT record_type, unnest(string_split(reasons, '|')) AS rule FROM ({ALL_CHECKED})
              WHERE reasons <> '') GROUP BY ALL"""),
    **{f"enrich_{k}": sql(q) for k, q in ENRICH.items()},
    "link_predictions": sql("""
        SELECT prediction_id, t.direction_id, r.route_name, s.stop_name
        FROM v_predictions p LEFT JOIN v_trips t ON t.id = p.trip_id
        LEFT JOIN v_routes r ON r.id = p.route_id LEFT JOIN v_stops s ON s.id = p.stop_id"""),
    "link_positions": sql("""
        SELECT vehicle_id, timestamp, t.route_id AS trip_route, r.route_type
        FROM v_vehicle_positions p LEFT JOIN v_trips t ON t.id = p.trip_id
        LEFT JOIN v_routes r ON r.id = p.route_id"""),
    "flatten_rest_predictions": sql(REST_PREDICTION),
    "flatten_rest_vehicles": sql(REST_VEHICLE),
    "split_rest_feed": sql("""
        SELECT 'prediction' AS part, count(*) AS records FROM v_predictions
        UNION ALL SELECT 'vehicle', count(*) FROM v_vehicle_positions
        UNION ALL SELECT 'unknown', count(*) FROM v_alerts
        UNION ALL SELECT 'undecodable', count(*) FROM v_stops"""),
    "combined_pull": sql("""
        SELECT type, route_id, count(*) AS records
        FROM (SELECT 'prediction' AS type, route_id FROM v_predictions
              UNION ALL SELECT 'vehicle', route_id FROM v_vehicle_positions)
        WHERE route_id IN ('Red', 'Orange', 'Blue', 'Green-B', 'Green-C', 'Green-D', 'Green-E') GROUP BY ALL"""),
    "pick_predictions": sql("""
        SELECT prediction_id, route_id, stop_id FROM v_predictions
        WHERE route_id IN ('Red', 'Blue') AND stop_id IN ('S1', 'S2', 'S3')"""),
    "route_directory": sql("""
        SELECT id AS route_id, CASE WHEN route_type = 4 THEN id ELSE route_name END AS name,
               route_type AS type, route_color AS color, NULL::VARCHAR AS text_color FROM v_routes"""),
    "pick_routes_by_type": sql("""
        SELECT id AS route_id, route_type AS type FROM v_routes WHERE route_type IN (0, 1)"""),
    "flatten_feed_positions": sql("""
        SELECT CASE WHEN direction_id = 0 THEN vehicle_id ELSE 'E' || id END AS vehicle_id, trip_id, route_id,
               latitude, longitude, bearing, speed, date_trunc('second', timestamp) AS timestamp,
               date_trunc('second', received_at) AS feed_timestamp
        FROM v_vehicle_positions"""),
    "flatten_feed_trip_updates": sql(f"""
        SELECT trip_id, vehicle_id, route_id, date_trunc('second', timestamp) AS timestamp,
               {MEAN_DELAY} AS delay, len(stop_ids) AS stop_events,
               array_to_string(stop_ids, '|') AS stop_ids FROM v_trip_updates"""),
    "flatten_feed_alerts": sql(f"""
        SELECT alert_id, alert_header_text, NULL::VARCHAR AS alert_description_text,
               date_trunc('second', active_period_start) AS effective_start_date,
               date_trunc('second', active_period_end) AS effective_end_date,
               {ROUTES_TEXT}, {STOPS_TEXT}, alert_severity_level, alert_effect AS effect FROM v_alerts"""),
    "feed_entity_types": sql("""
        SELECT 'vehicle' AS entity, count(*) AS records FROM v_vehicle_positions
        UNION ALL SELECT 'trip_update', count(*) FROM v_trip_updates
        UNION ALL SELECT 'alert', count(*) FROM v_alerts"""),
    "loose_record_types": sql(" UNION ALL ".join(
        f"SELECT '{k}' AS record_type, count(*) AS records FROM {RULES[k][0]}" for k in RULES)),
    **{f"typed_{k}": sql(q) for k, q in TYPED.items()},
    "parse_times": sql("""
        SELECT id, CASE id % 6 WHEN 0 THEN timestamp WHEN 1 THEN date_trunc('second', timestamp)
                   WHEN 2 THEN date_trunc('second', timestamp) + INTERVAL 5 HOURS
                   WHEN 4 THEN date_trunc('second', timestamp) END AS parsed
        FROM v_predictions"""),
    "code_mapping": sql("""
        SELECT id, CASE schedule_relationship WHEN 'scheduled' THEN 0 WHEN 'ADDED' THEN 1
                        WHEN 'canceled' THEN 3 END AS schedule,
               CASE id % 5 WHEN 0 THEN 0 WHEN 1 THEN 5 WHEN 2 THEN 2 WHEN 3 THEN 3 END AS occupancy,
               (id % 7)::INTEGER AS congestion
        FROM v_predictions"""),
    "prediction_rows": sql("""
        SELECT trip_id, route_id, stop_id, vehicle_id, arrival_time, departure_time,
               CASE schedule_relationship WHEN 'scheduled' THEN 0 WHEN 'ADDED' THEN 1 WHEN 'canceled' THEN 3 END
                   AS schedule_relationship,
               delay, timestamp, 'feed' AS source, timestamp AS processed_at, 'batch-1' AS batch_id,
               strftime(timestamp, '%Y-%m-%d') AS partition_date,
               coalesce(strftime(arrival_time, '%Y-%m-%d'), 'none') AS arrival_date
        FROM v_predictions"""),
    "alert_rows": sql("""
        SELECT alert_id, alert_header_text, alert_effect, alert_severity_level,
               array_to_string(affected_route_ids, '|') AS affected_route_ids,
               array_to_string(affected_stop_ids, '|') AS affected_stop_ids,
               active_period_start, active_period_end, timestamp,
               'feed' AS source, timestamp AS processed_at, 'batch-1' AS batch_id,
               strftime(timestamp, '%Y-%m-%d') AS partition_date
        FROM v_alerts"""),
    "position_rows": sql("""
        SELECT vehicle_id, trip_id, route_id, NULL::INTEGER AS direction_id, latitude, longitude, congestion_level,
               NULL::INTEGER AS occupancy_status, timestamp, 'feed' AS source, received_at AS processed_at,
               'batch-1' AS batch_id, strftime(timestamp, '%Y-%m-%d') AS partition_date
        FROM v_vehicle_positions"""),
    "trip_update_rows": sql(f"""
        SELECT trip_id, route_id, {MEAN_DELAY} AS delay, timestamp, 'feed' AS source, received_at AS processed_at,
               'batch-1' AS batch_id, strftime(timestamp, '%Y-%m-%d') AS partition_date
        FROM v_trip_updates"""),
    "flatten_rest_response": sql("""
        SELECT prediction_id, trip_id, stop_id, route_id, arrival_time, delay
        FROM (SELECT * FROM v_predictions UNION ALL SELECT * FROM v_predictions)"""),
    "lineage": sql(f"""
        SELECT id, timestamp AS created_at, {AS_OF} AS processed_at, 'rest_feed' AS source, '1.0' AS version,
               'batch-1' AS batch_id, strftime(timestamp, '%Y-%m-%d') AS partition_date
        FROM v_predictions"""),
    "trip_delay_from_stops": sql(f"SELECT trip_id, timestamp, {MEAN_DELAY} AS delay FROM v_trip_updates"),
    "update_significance": sql(f"""
        SELECT trip_id, {LARGE} AS large_delays, {SIGNIFICANCE} AS significance FROM v_trip_updates"""),
    "affected_services": sql(f"SELECT alert_id, {SERVICES} AS services FROM v_alerts"),
    "upsert_predictions": sql(FIRST),
    "upsert_predictions_added": sql(f"SELECT * FROM ({FIRST}) WHERE timestamp >= {MID}"),
    "upsert_alerts": sql(f"SELECT alert_id, alert_effect, timestamp FROM v_alerts WHERE timestamp >= {MID}"),
    "upsert_trips": sql("""
        SELECT id, route_id FROM v_trips UNION ALL
        SELECT trip_id, min(route_id) FROM v_trip_updates
        WHERE trip_id NOT IN (SELECT id FROM v_trips) GROUP BY 1"""),
    "placeholder_routes": sql("""
        SELECT DISTINCT route_id AS id, 'Route ' || route_id AS route_name, 0 AS route_type
        FROM v_predictions WHERE route_id NOT IN (SELECT id FROM v_routes)"""),
    "placeholder_stops": sql("""
        SELECT DISTINCT stop_id AS id, 'Stop ' || stop_id AS stop_name
        FROM v_predictions WHERE stop_id NOT IN (SELECT id FROM v_stops WHERE id NOT LIKE '%7')"""),
    "placeholder_trips": sql("""
        SELECT DISTINCT trip_id AS id, 'unknown' AS route_id, 'unknown' AS service_id
        FROM v_trip_updates WHERE trip_id NOT IN (SELECT id FROM v_trips)"""),
    "placeholder_vehicles": sql("""
        SELECT DISTINCT v AS id, v AS vehicle_id, NULL::VARCHAR AS vehicle_label
        FROM (SELECT 'V' || substr(trip_id, 2) AS v FROM v_predictions)
        WHERE v NOT IN (SELECT vehicle_id FROM v_vehicles)"""),
    "unknown_route": sql("""
        SELECT 'unknown' AS id, 'Route unknown' AS route_name, 0 AS route_type
        WHERE 'unknown' NOT IN (SELECT id FROM v_routes)"""),
    "seed_routes_kept": f"SELECT * FROM (VALUES {SEED_NAMES}) s(id, route_name)",
    "topic_routing": sql(f"""
        SELECT topic, key, count(*) AS messages, count(route_id) AS with_route FROM ({MESSAGES}) GROUP BY ALL"""),
    "topic_payloads": sql("""
        SELECT 'transit.predictions.raw' AS topic, coalesce(trip_id, prediction_id) AS key, prediction_id, stop_id,
               delay::VARCHAR AS delay, strftime(arrival_time, '%Y-%m-%dT%H:%M:%S.%f') AS arrival_time,
               NULL::VARCHAR AS vehicle_label
        FROM v_predictions"""),
    "store_round_trip": sql(f"""
        SELECT 'predictions' AS table_name, count(*) AS rows
        FROM (SELECT DISTINCT trip_id, stop_id, arrival_time FROM v_predictions)
        UNION ALL SELECT 'vehicle_positions', count(*) FROM v_vehicle_positions
        UNION ALL SELECT 'alerts', count(*) FROM v_alerts
        UNION ALL SELECT 'vehicles', count(*) FROM v_vehicles
        UNION ALL SELECT 'trip_updates', count(*) FROM v_trip_updates
        UNION ALL SELECT 'data_ingestion_logs', 7
        UNION ALL SELECT 'trips', count(*) FROM (
            SELECT id FROM v_trips UNION SELECT trip_id FROM v_predictions UNION SELECT trip_id FROM v_vehicle_positions
            UNION SELECT trip_id FROM v_trip_updates)
        UNION ALL SELECT 'stops', count(*) FROM (
            SELECT id FROM v_stops UNION SELECT stop_id FROM v_predictions)
        UNION ALL SELECT 'routes', count(*) FROM (
            SELECT id FROM v_routes UNION SELECT route_id FROM v_predictions
            UNION SELECT route_id FROM v_vehicle_positions WHERE route_id IS NOT NULL
            UNION SELECT route_id FROM v_trip_updates UNION SELECT 'unknown'
            UNION SELECT route_id FROM v_trips UNION SELECT * FROM (VALUES {SEEDS}))"""),
    "store_replay": sql("""
        SELECT strftime(CASE WHEN bearing::BIGINT % 7 <> 0 THEN timestamp END, '%Y-%m-%d') AS partition_date,
               CASE WHEN vehicle_id < 'V3' THEN 'first' ELSE 'second' END AS batch_id, count(*) AS rows
        FROM v_vehicle_positions GROUP BY 1, 2"""),
    "stream_hourly_delays": sql(f"""
        SELECT date_trunc('hour', timestamp) AS hour_bucket, count(*) AS total_predictions,
               {LATE} AS delayed_count, {mins('sum(delay)', 'count(delay)')} AS avg_delay_minutes,
               {r2('max(delay)/60.0::DOUBLE')} AS max_delay_minutes,
               {pct(LATE, 'count(*)')} AS delay_percentage, true AS active_routes_near, true AS active_stops_near
        FROM v_predictions GROUP BY 1"""),
    "stream_sliding_kpis": sql(f"""
        SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, count(*) AS total_predictions,
               {LATE} AS delayed_count, {pct(f'count(*) - {LATE}', 'count(*)')} AS on_time_percentage,
               {mins(f'sum({POS})', 'count(*)')} AS avg_delay_minutes
        FROM (SELECT *, unnest([time_bucket(INTERVAL 15 MINUTES, timestamp) - to_minutes(15*i)
                                for i in range(4)]) AS s FROM v_predictions)
        GROUP BY s"""),
    "stream_live_cards": sql(f"""
        SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, card.data_type, card.count, card.delayed_count,
               card.avg_delay_minutes
        FROM (SELECT s, unnest([
                  {{'data_type': 'predictions', 'count': count(*) FILTER (k = 'p'), 'delayed_count': count(*) FILTER (k = 'p' AND v > 0),
                    'avg_delay_minutes': {mins("sum(greatest(coalesce(v, 0), 0)) FILTER (k = 'p')", "count(*) FILTER (k = 'p')")}}},
                  {{'data_type': 'vehicles', 'count': count(DISTINCT vehicle_id) FILTER (k = 'v'),
                    'delayed_count': count(*) FILTER (k = 'v' AND v > 0),
                    'avg_delay_minutes': ((2*sum(speed_cms) + count(speed_cms)) // nullif(2*count(speed_cms), 0)) / 100.0::DOUBLE}},
                  {{'data_type': 'alerts', 'count': count(*) FILTER (k = 'a'), 'delayed_count': count(*) FILTER (k = 'a' AND v > 0),
                    'avg_delay_minutes': 0.0::DOUBLE}}]) AS card
              FROM (SELECT *, unnest([time_bucket(INTERVAL 15 MINUTES, timestamp) - to_minutes(15*i) for i in range(4)]) AS s FROM (
                  SELECT 'p' AS k, timestamp, delay AS v, NULL AS vehicle_id, NULL AS speed_cms FROM v_predictions
                  UNION ALL SELECT 'v', timestamp, congestion_level, vehicle_id, speed_cms FROM v_vehicle_positions
                  UNION ALL SELECT 'a', timestamp, CAST(coalesce(alert_severity_level = 'high', false) AS INT), NULL, NULL FROM v_alerts))
              GROUP BY s)"""),
    "stream_sessions": sql(f"""
        SELECT vehicle_id, min(timestamp) AS session_start, max(timestamp) + INTERVAL 30 MINUTES AS session_end,
               count(*) AS reports, max(speed) AS max_speed
        FROM (SELECT *, sum(opens) OVER (PARTITION BY vehicle_id ORDER BY timestamp, id) AS spell
              FROM (SELECT *, CASE WHEN timestamp - lag(timestamp) OVER (
                        PARTITION BY vehicle_id ORDER BY timestamp, id) < INTERVAL 30 MINUTES
                        THEN 0 ELSE 1 END AS opens FROM v_vehicle_positions))
        GROUP BY vehicle_id, spell"""),
    "stream_dedupe": sql("""
        SELECT DISTINCT trip_id, stop_id, arrival_time, 1::BIGINT AS rows FROM v_predictions"""),
    "stream_running_totals": sql("""
        SELECT 'predictions' AS record_type, count(*) AS count, min(timestamp) AS first_seen,
               max(timestamp) AS last_seen FROM v_predictions
        UNION ALL SELECT 'vehicle_positions', count(*), min(timestamp), max(timestamp) FROM v_vehicle_positions
        UNION ALL SELECT 'alerts', count(*), min(timestamp), max(timestamp) FROM v_alerts
        UNION ALL SELECT 'trip_updates', count(*), min(timestamp), max(timestamp) FROM v_trip_updates"""),
    "stream_headways": sql(f"""
        SELECT route_id, direction_id, timestamp, count(*) AS reports,
               (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (
                   PARTITION BY route_id, direction_id ORDER BY timestamp)))/1000000.0::DOUBLE
                   AS headway_seconds
        FROM v_vehicle_positions GROUP BY route_id, direction_id, timestamp"""),
    "stream_feed_stalls": sql("""
        SELECT source_type, unnest(['active', 'stalled']) AS state,
               unnest([min(timestamp), max(timestamp) + INTERVAL 2 HOURS]) AS since, count(*) AS runs, sum(n)::BIGINT AS records
        FROM (SELECT *, sum(opens) OVER (PARTITION BY source_type ORDER BY timestamp, id) AS spell
              FROM (SELECT *, CASE WHEN timestamp - lag(timestamp) OVER (
                        PARTITION BY source_type ORDER BY timestamp, id) < INTERVAL 2 HOURS THEN 0 ELSE 1 END AS opens
                    FROM (SELECT vehicle_id AS source_type, timestamp, abs(delay) AS n, row_number() OVER () AS id
                          FROM v_predictions WHERE abs(delay) > 0)))
        GROUP BY source_type, spell"""),
    "kept_summary": ANALYTICS["q_performance"],
    "stream_ingest": sql(f"""
        SELECT 'predictions' AS table_name, count(*) AS rows FROM (
            SELECT DISTINCT trip_id, stop_id, arrival_time FROM v_predictions WHERE {GOOD_PREDICTION})
        UNION ALL SELECT 'vehicle_positions', count(*) FROM v_vehicle_positions WHERE {GOOD_POSITION}
        UNION ALL SELECT 'refused_prediction', count(*) FROM v_predictions WHERE NOT ({GOOD_PREDICTION})
        UNION ALL SELECT 'refused_vehicle_position', count(*) FROM v_vehicle_positions WHERE NOT ({GOOD_POSITION})
        UNION ALL SELECT 'refused_unknown', (SELECT count(*) FROM v_alerts) + (SELECT count(*) FROM v_stops)"""),
}
