"""SQL of the summaries, rules, listings and health queries."""

from oracle.views import AS_OF, LATE, POS, div, mins, pct, r2, sql, window

P, V, A = window("v_predictions"), window("v_vehicle_positions"), window("v_alerts")


def stats(d: str) -> str:
    return (
        f"coalesce({div(f'sum({d})', f'count({d})')}, 0.0::DOUBLE) AS avg_delay, "
        f"coalesce(max({d}), 0) AS max_delay, coalesce(min({d}), 0) AS min_delay")


NONZERO = "nullif(delay, 0)"
ACTIVE = (
    f"(active_period_start IS NULL OR active_period_start <= {AS_OF}) AND "
    f"(active_period_end IS NULL OR active_period_end >= {AS_OF})")
STATUS = (
    "CASE WHEN share > 20 OR total_alerts > 10 THEN 'poor' WHEN share > 10 OR total_alerts > 5 THEN 'fair' "
    "WHEN share > 5 OR total_alerts > 2 THEN 'good' ELSE 'excellent' END")


def by_key(key: str, array: str, positions: bool) -> str:
    p = f"SELECT {key} AS k, count(*) AS n, {stats(NONZERO)} FROM v_predictions GROUP BY 1"
    a = (
        f"SELECT k, count(*) AS n FROM (SELECT unnest({array}) AS k FROM v_alerts) GROUP BY 1")
    columns, join = "", ""
    if positions:
        columns = "coalesce(v.n, 0) AS vehicle_positions,"
        join = f"FULL JOIN (SELECT {key} AS k, count(*) AS n FROM v_vehicle_positions GROUP BY 1) v USING (k)"
    return sql(f"""
        SELECT k AS {key}, coalesce(p.n, 0) AS predictions, {columns} coalesce(a.n, 0) AS alerts,
               coalesce(avg_delay, 0.0::DOUBLE) AS avg_delay, coalesce(max_delay, 0) AS max_delay,
               coalesce(min_delay, 0) AS min_delay
        FROM ({p}) p {join} FULL JOIN ({a}) a USING (k)""")


def performance(rows: str) -> str:
    return sql(f"""
        SELECT CASE WHEN count(*) = 0 THEN 0.0::DOUBLE WHEN count(delay) = 0 THEN 100.0::DOUBLE
                    ELSE (count(*) - {LATE})*100.0::DOUBLE/count(*) END AS on_time_percentage,
               coalesce({div('sum(delay)', 'count(delay)')}, 0.0::DOUBLE) AS average_delay,
               {r2('coalesce(stddev_samp(delay), 0.0::DOUBLE)')} AS delay_std_dev,
               count(*) AS total_trips, {LATE} AS delayed_trips,
               count(*) FILTER (delay > 300) AS severely_delayed_trips
        FROM ({rows}) WHERE timestamp >= {AS_OF} - INTERVAL 720 HOURS""")


GUARDED = f"""
    SELECT r.id AS route_id, r.route_name, count(p.id) AS total_predictions, {LATE} AS delayed_predictions,
           CASE WHEN count(p.id) = 0 THEN 0.0::DOUBLE ELSE {pct(f'count(p.id) - {LATE}', 'count(p.id)')} END
               AS on_time_percentage,
           coalesce({mins(f'sum({POS})', 'count(p.id)')}, 0.0::DOUBLE) AS avg_delay_minutes
    FROM v_routes r LEFT JOIN {P} p ON r.id = p.route_id GROUP BY r.id, r.route_name"""

TABLES = ["routes", "stops", "trips", "predictions", "vehicle_positions", "alerts", "trip_updates"]

LOG = """
    SELECT vehicle_id AS source_type,
           CASE WHEN delay IS NULL THEN 'error' WHEN delay < 0 THEN 'partial' ELSE 'success' END AS status,
           abs(coalesce(delay, 0)) AS processed, greatest(coalesce(delay, 0), 0) AS inserted,
           greatest(-coalesce(delay, 0), 0) AS failed, timestamp AS done
    FROM v_predictions"""
INGESTION = """
    SELECT source_type, count(*) AS runs, sum(processed)::BIGINT AS records_processed,
           sum(inserted)::BIGINT AS records_inserted, sum(failed)::BIGINT AS records_failed,
           count(*) FILTER (status = 'error') AS total_errors,
           max(done) FILTER (status <> 'error') AS last_success,
           count(*) FILTER (status = 'error' AND later_good = 0) AS consecutive_failures
    FROM (SELECT *, sum(CASE WHEN status <> 'error' THEN 1 ELSE 0 END) OVER (
              PARTITION BY source_type ORDER BY done DESC) AS later_good FROM log)
    GROUP BY source_type"""

AFFECTED = (
    "(SELECT string_agg(x, '|' ORDER BY x) FROM (SELECT DISTINCT unnest({c}) AS x FROM recent_notices))")

QUERIES = {
    "route_summary": by_key("route_id", "affected_route_ids", True),
    "stop_summary": by_key("stop_id", "affected_stop_ids", False),
    "time_window_summary": sql(f"""
        SELECT since AS start_time, {AS_OF} AS end_time, p.*,
               (SELECT count(*) FROM v_vehicle_positions WHERE timestamp >= since) AS vehicle_positions,
               (SELECT count(*) FROM v_trip_updates WHERE timestamp >= since) AS trip_updates,
               (SELECT count(*) FROM v_alerts WHERE active_period_start >= since
                    OR active_period_end >= since) AS alerts
        FROM (SELECT {AS_OF} - INTERVAL 720 HOURS AS since),
             (SELECT count(*) AS predictions, {stats(NONZERO)} FROM v_predictions
              WHERE arrival_time >= {AS_OF} - INTERVAL 720 HOURS) p"""),
    "service_health": sql(f"""
        SELECT total_predictions, total_vehicles, total_alerts, {r2('share')} AS delay_percentage,
               minor, moderate, major, {STATUS} AS service_status
        FROM (SELECT count(*) AS total_predictions,
                     coalesce({div(f'({LATE})*100.0::DOUBLE', 'count(*)')}, 0) AS share,
                     count(*) FILTER (delay > 0 AND delay <= 300) AS minor,
                     count(*) FILTER (delay > 300 AND delay <= 900) AS moderate,
                     count(*) FILTER (delay > 900) AS major,
                     (SELECT count(*) FROM v_vehicle_positions) AS total_vehicles,
                     (SELECT count(*) FROM v_alerts) AS total_alerts
              FROM v_predictions)"""),
    "type_summary": sql(" UNION ALL ".join(
        f"SELECT '{n}' AS record_type, count(*) AS count, {lo} AS first_seen, {hi} AS last_seen FROM v_{n}"
        for n, lo, hi in (
            [(n, AS_OF, AS_OF) for n in ("routes", "stops", "trips", "vehicles")]
            + [(n, "min(timestamp)", "max(timestamp)")
               for n in ("predictions", "vehicle_positions", "alerts", "trip_updates")]))),
    "service_metrics": sql(f"""
        SELECT count(*) AS total_predictions, count(DISTINCT route_id) AS active_routes,
               count(DISTINCT stop_id) AS active_stops, {LATE} AS delayed_predictions,
               (SELECT count(*) FROM v_vehicle_positions) AS total_vehicles
        FROM v_predictions"""),
    "performance_metrics": sql(f"""
        SELECT {stats('delay')}, count(delay) AS delay_count FROM v_predictions"""),
    "alert_totals": sql(f"""
        SELECT count(*) AS total_alerts, count(*) FILTER ({ACTIVE}) AS active_alerts FROM v_alerts"""),
    "alert_summary": sql(f"""
        SELECT total_alerts, active_alerts, severity, alerts
        FROM (SELECT count(*) AS total_alerts, count(*) FILTER ({ACTIVE}) AS active_alerts FROM v_alerts),
             (SELECT alert_severity_level AS severity, count(*) AS alerts FROM v_alerts
              WHERE alert_severity_level IS NOT NULL GROUP BY 1)"""),
    "geographic_summary": sql("""
        SELECT (SELECT count(*) FROM v_stops) AS total_stops,
               (SELECT count(*) FROM v_vehicle_positions) AS total_vehicles,
               CASE WHEN stop_lat > 42.4::DOUBLE THEN 'North Shore' WHEN stop_lat < 42.3::DOUBLE THEN 'South Shore'
                    WHEN stop_lon > -71.0::DOUBLE THEN 'East Boston' WHEN stop_lon < -71.1::DOUBLE
                    THEN 'West Boston' ELSE 'Central Boston' END AS region, count(*) AS stops
        FROM v_stops WHERE stop_lat IS NOT NULL AND stop_lon IS NOT NULL GROUP BY region"""),
    "summary_stats": sql(f"""
        SELECT {AS_OF} AS timestamp, s.*, p.*,
               {' + '.join(f'(SELECT count(*) FROM v_{n})' for n in TABLES)} AS total_records,
               {AS_OF} AS stops_seen, (SELECT max(timestamp) FROM v_vehicle_positions) AS last_position,
               (SELECT count(*) FROM v_alerts WHERE {ACTIVE}) AS active_alerts,
               (SELECT count(*) FROM v_alerts WHERE alert_severity_level = 'SEVERE') AS severe_alerts,
               (SELECT count(*) FROM v_stops) AS total_stops
        FROM (SELECT count(*) AS predictions, count(DISTINCT route_id) AS active_routes,
                     count(DISTINCT stop_id) AS active_stops, {LATE} AS delayed_predictions
              FROM v_predictions) s,
             (SELECT {div('sum(delay)', 'count(delay)')} AS avg_delay, count(delay) AS delay_count
              FROM v_predictions) p"""),
    "stored_service_health": sql(f"""
        SELECT 720.0::DOUBLE AS time_window_hours, count(*) AS total_predictions,
               {LATE} AS delayed_predictions, {pct(LATE, 'count(*)')} AS delay_percentage,
               (SELECT count(*) FROM {A}) AS total_alerts
        FROM {P}"""),
    "window_performance": performance("SELECT * FROM v_predictions"),
    "route_performance": performance("SELECT * FROM v_predictions WHERE route_id = 'Red'"),
    "route_on_time_guarded": sql(GUARDED),
    "route_on_time_with_data": sql(f"SELECT * FROM ({GUARDED}) WHERE total_predictions > 0"),
    "table_counts": sql(" UNION ALL ".join(
        [f"SELECT '{n}' AS table_name, count(*) AS rows FROM v_{n}" for n in TABLES]
        + [f"SELECT 'predictions_last_hour', count(*) FROM {window('v_predictions', 1)}"])),
    "alert_cards": sql(f"""
        SELECT count(*) AS total_alerts, count(*) FILTER (alert_severity_level = 'SEVERE') AS severe_alerts,
               count(affected_route_ids) AS routes_affected
        FROM {A}"""),
    "vehicles_per_route": sql("""
        SELECT route_id, count(DISTINCT vehicle_id) AS vehicles FROM v_vehicle_positions GROUP BY 1"""),
    "busiest_routes": sql("""
        SELECT route_id, count(DISTINCT vehicle_id) AS vehicles FROM v_vehicle_positions
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3"""),
    "route_type_histogram": sql("SELECT route_type, count(*) AS routes FROM v_routes GROUP BY 1"),
    "problem_routes_topk": sql("""
        SELECT route_id, count(*) AS delays FROM v_predictions WHERE delay > 120
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""),
    "vehicles_by_hour_of_day": sql("""
        SELECT h::INTEGER AS hour, count(DISTINCT vehicle_id) AS vehicles
        FROM range(24) t(h) LEFT JOIN v_vehicle_positions ON extract(hour FROM timestamp) = h GROUP BY 1"""),
    "delay_distribution": sql(f"""
        SELECT count(*) AS total_delays, count(*) FILTER (delay <= 300) AS minor,
               count(*) FILTER (delay > 300 AND delay <= 900) AS moderate,
               count(*) FILTER (delay > 900) AS major,
               {mins('sum(delay)', 'count(*)')} AS average_delay_minutes,
               {r2('max(delay)/60.0::DOUBLE')} AS max_delay_minutes
        FROM v_predictions WHERE delay > 120"""),
    "service_summary": sql(f"""
        SELECT {AS_OF} AS timestamp, 720.0::DOUBLE AS time_window_hours, perf.*, h.*,
               extreme + noisy AS anomalies, (extreme > 0 AND over > 5)::BIGINT + noisy AS high_anomalies,
               CASE WHEN score >= 80 THEN 'excellent' WHEN score >= 60 THEN 'good'
                    WHEN score >= 40 THEN 'fair' ELSE 'poor' END AS overall_status
        FROM perf, h, (SELECT count(*) AS over, (count(*) > 0)::BIGINT AS extreme FROM newest, limits
                       WHERE delay > threshold) x,
             (SELECT (count(*) > 10)::BIGINT AS noisy FROM {A}) y,
             LATERAL (SELECT 100 - CASE WHEN on_time_percentage < 80 THEN 20
                                        WHEN on_time_percentage < 90 THEN 10 ELSE 0 END
                      - 15*((extreme > 0 AND over > 5)::INTEGER + noisy)
                      - CASE WHEN total_alerts > 5 THEN 10 ELSE 0 END AS score) z""",
        newest=f"SELECT * FROM {P}",
        limits="SELECT avg(delay) + 3*coalesce(stddev_samp(delay), 0) AS threshold FROM newest",
        perf=f"""
        SELECT (count(*) - {LATE})*100.0::DOUBLE/count(*) AS on_time_percentage,
               {div('sum(delay)', 'count(delay)')}/60.0::DOUBLE AS average_delay_minutes,
               {LATE} AS delayed_trips, count(*) AS total_trips FROM {P}""",
        h=f"""
        SELECT count(*) AS total_predictions, {LATE} AS delayed_predictions,
               {pct(LATE, 'count(*)')} AS delay_percentage,
               (SELECT count(*) FROM {A}) AS total_alerts FROM {P}"""),
    "latest_stats": sql(f"""
        SELECT (SELECT count(*) FROM v_routes) AS total_routes,
               (SELECT count(DISTINCT vehicle_id) FROM v_vehicle_positions) AS active_vehicles,
               (SELECT count(*) FROM v_alerts WHERE {ACTIVE}) AS active_alerts,
               d.*, {AS_OF} AS last_updated,
               (SELECT string_agg(route_id || ':' || n, '|' ORDER BY route_id) FROM (
                   SELECT route_id, count(*) AS n FROM v_predictions
                   WHERE delay > 120 AND route_id IS NOT NULL GROUP BY 1)) AS problem_routes,
               (SELECT string_agg(n::VARCHAR, '|' ORDER BY h) FROM (
                   SELECT h, count(DISTINCT vehicle_id) AS n FROM range(24) t(h)
                   LEFT JOIN v_vehicle_positions ON extract(hour FROM timestamp) = h GROUP BY 1))
                   AS hourly_vehicle_counts
        FROM (SELECT count(*) AS total_delays, count(*) FILTER (delay <= 300) AS minor,
                     count(*) FILTER (delay > 300 AND delay <= 900) AS moderate,
                     count(*) FILTER (delay > 900) AS major,
                     {mins('sum(delay)', 'count(*)')} AS average_delay_minutes,
                     {r2('max(delay)/60.0::DOUBLE')} AS max_delay_minutes
              FROM v_predictions WHERE delay > 120) d"""),
    "latest_stats_vehicle_locations": sql("""
        SELECT route_id AS route, latitude AS lat, longitude AS lng FROM v_vehicle_positions
        QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY timestamp DESC, id DESC) = 1"""),
    "latest_stats_service_alerts": sql(f"""
        SELECT alert_header_text AS title, alert_severity_level AS severity, alert_effect AS description,
               array_to_string(affected_route_ids, '|') AS affected_routes, timestamp AS updated_at
        FROM v_alerts WHERE {ACTIVE}"""),
    "delay_anomaly": sql("""
        SELECT 'extreme_delays' AS anomaly_type, CASE WHEN n > 5 THEN 'high' ELSE 'medium' END AS severity,
               'Detected ' || n || ' extreme delays above threshold' AS description,
               affected_routes, '' AS affected_stops, 0.85::DOUBLE AS confidence_score
        FROM (SELECT count(*) AS n, string_agg(DISTINCT route_id, '|' ORDER BY route_id) AS affected_routes
              FROM newest, limits WHERE delay > threshold) WHERE n > 0""",
        newest=f"SELECT * FROM {P}",
        limits="SELECT avg(delay) + 3*coalesce(stddev_samp(delay), 0) AS threshold FROM newest"),
    "service_disruption": sql(f"""
        SELECT 'service_disruption' AS anomaly_type, 'high' AS severity,
               'High number of active alerts: ' || count(*) AS description,
               {AFFECTED.format(c='affected_route_ids')} AS affected_routes,
               {AFFECTED.format(c='affected_stop_ids')} AS affected_stops, 0.9::DOUBLE AS confidence_score
        FROM recent_notices HAVING count(*) > 10""", recent_notices=f"SELECT * FROM {A}"),
    "headway_one_route": sql(f"""
        SELECT 'Red' AS route_id, 0 AS direction_id, count(s) AS total_headways,
               {r2('avg(s)')} AS average_headway, {r2('var_samp(s)/3600.0::DOUBLE')} AS headway_variance_minutes,
               count(*) FILTER (s < 180) AS bunching_incidents, count(*) FILTER (s > 900) AS gap_incidents
        FROM (SELECT (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (ORDER BY timestamp, id)))
                     /1000000.0::DOUBLE AS s
              FROM v_vehicle_positions WHERE route_id = 'Red' AND direction_id = 0) HAVING count(s) > 0"""),
    "route_listing": sql("""
        SELECT id, route_name AS name, route_type AS type, route_color AS color,
               NULL::VARCHAR AS text_color FROM v_routes"""),
    "stops_for_route": sql("""
        SELECT DISTINCT s.id, stop_name AS name, stop_lat AS latitude, stop_lon AS longitude,
               wheelchair_boarding
        FROM v_stops s JOIN v_predictions p ON p.stop_id = s.id WHERE p.route_id = 'Red'"""),
    "stop_listing": sql("""
        SELECT id, stop_name AS name, stop_lat AS latitude, stop_lon AS longitude, wheelchair_boarding
        FROM v_stops"""),
    "alert_listing": sql("""
        SELECT alert_header_text AS header, alert_severity_level AS severity,
               strftime(timestamp, '%Y-%m-%d %H:%M') AS timestamp, NULL::VARCHAR AS description FROM v_alerts"""),
    "stops_in_box": sql("""
        SELECT count(*) AS stops FROM v_stops WHERE stop_lat BETWEEN 42.35::DOUBLE AND 42.37::DOUBLE
        AND stop_lon BETWEEN -71.07::DOUBLE AND -71.05::DOUBLE"""),
    "route_colours": sql("""
        SELECT p.route_id, CASE
            WHEN r.id IS NOT NULL THEN '#' || route_color WHEN contains(p.route_id, 'Green') THEN '#00843D'
            WHEN contains(p.route_id, 'Red') THEN '#DA291C' WHEN contains(p.route_id, 'Orange') THEN '#ED8B00'
            WHEN contains(p.route_id, 'Blue') THEN '#003DA5'
            WHEN contains(p.route_id, 'Commuter Rail') THEN '#A020F0'
            WHEN contains(p.route_id, 'Bus') THEN '#FFFF00' ELSE '#95a5a6' END AS colour
        FROM (SELECT DISTINCT route_id FROM v_vehicle_positions) p LEFT JOIN v_routes r ON r.id = p.route_id"""),
    "recent_predictions": sql("""
        SELECT id, trip_id, route_id, stop_id, strftime(arrival_time, '%Y-%m-%dT%H:%M:%S.%f') AS arrival_time,
               delay, strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp
        FROM (SELECT * FROM v_predictions ORDER BY timestamp DESC, id LIMIT 100)"""),
    "recent_alerts": sql("""
        SELECT alert_id, alert_header_text, alert_severity_level, active_period_start, active_period_end,
               array_to_string(affected_route_ids, '|') AS affected_routes, timestamp
        FROM v_alerts ORDER BY timestamp DESC, alert_id LIMIT 20"""),
    "recent_alerts_in_window": sql(f"""
        SELECT alert_id, alert_severity_level, timestamp FROM {window('v_alerts', 360)}
        ORDER BY timestamp DESC, alert_id LIMIT 50"""),
    "headway_route_in_window": sql(f"""
        SELECT 'Red' AS route_id, direction_id, count(s) AS total_headways, {r2('avg(s)')} AS average_headway,
               count(*) FILTER (s < 180) AS bunching_incidents, count(*) FILTER (s > 900) AS gap_incidents
        FROM (SELECT direction_id, (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (
                     PARTITION BY direction_id ORDER BY timestamp, id)))/1000000.0::DOUBLE AS s
              FROM {window('v_vehicle_positions', 360)} WHERE route_id = 'Red')
        GROUP BY direction_id HAVING count(s) > 0"""),
    "latest_stats_route_vehicle_counts": sql("""
        SELECT route_id, count(DISTINCT vehicle_id) AS vehicles FROM v_vehicle_positions
        WHERE route_id IS NOT NULL GROUP BY 1"""),
    "latest_stats_route_details": sql("""
        SELECT id AS route_id, route_name AS name, route_type AS type, route_color AS color FROM v_routes"""),
    "generic_feed_messages": sql("""
        SELECT id, CASE WHEN said THEN trip_id END AS trip_id,
               CASE WHEN said THEN CASE id % 5 WHEN 1 THEN 'ADDED' WHEN 2 THEN 'UNSCHEDULED' WHEN 3 THEN 'CANCELED' END END
                   AS trip_relationship,
               CASE WHEN said THEN CASE id % 4 WHEN 1 THEN 'STOPPED_AT' WHEN 2 THEN 'IN_TRANSIT_TO' END END AS current_status,
               CASE WHEN said THEN CASE id % 6 WHEN 1 THEN 'RUNNING_SMOOTHLY' WHEN 2 THEN 'STOP_AND_GO'
                    WHEN 3 THEN 'CONGESTION' WHEN 4 THEN 'SEVERE_CONGESTION' END END AS congestion_level,
               CASE WHEN said THEN CASE id % 3 WHEN 1 THEN 'SKIPPED|' WHEN 2 THEN 'NO_DATA|' ELSE '' END || 'SKIPPED' END
                   AS stop_relationships
        FROM (SELECT *, id % 7 <> 0 AS said FROM v_vehicle_positions)"""),
    "kpi_last_points": sql(f"""
        SELECT 'hourly_delays' AS kind, h AS as_of, count(p.id) AS total_predictions
        FROM (SELECT unnest(generate_series({AS_OF} - INTERVAL 23 HOURS, {AS_OF}, INTERVAL 1 HOUR)) AS h)
        LEFT JOIN v_predictions p ON date_trunc('hour', timestamp) = h GROUP BY h"""),
    "feed_freshness": sql("SELECT feed, last_update, age_seconds, "
        "CASE WHEN age_seconds < 300 THEN 'fresh' WHEN age_seconds < 900 THEN 'stale' ELSE 'old' END AS status, "
        "age_seconds <= 900 AS is_fresh, CASE WHEN age_seconds < 300 THEN 'live' "
        "WHEN age_seconds < 1800 THEN 'may be stale' ELSE 'stale' END AS data_tier FROM ("
        "SELECT feed, last_update, (epoch_us(TIMESTAMP '2024-01-31 00:05:00') - epoch_us(last_update))"
        "/1000000.0::DOUBLE AS age_seconds FROM ("
        + " UNION ALL ".join(
            f"SELECT '{n}' AS feed, max(timestamp) AS last_update FROM v_{n}"
            for n in ("predictions", "vehicle_positions", "alerts", "trip_updates")) + "))"),
    "ingestion_health": sql(f"""
        SELECT *, CASE WHEN consecutive_failures < 5 THEN 'healthy' ELSE 'degraded' END AS status
        FROM ({INGESTION})""", log=LOG),
    "trailing_minute_requests": sql("""
        SELECT 'feed' AS source_type, timestamp AS started_at, count(*) AS requests,
               sum(count(*)) OVER (ORDER BY epoch_us(timestamp) RANGE BETWEEN 59999999 PRECEDING
                                   AND CURRENT ROW)::BIGINT AS in_last_minute
        FROM v_predictions GROUP BY timestamp"""),
    "pipeline_health": sql(f"""
        SELECT i.*, {STATUS} AS service_status, {r2('share')} AS delay_percentage, total_alerts,
               n + (SELECT count(*) FROM v_vehicle_positions) + total_alerts AS total_records,
               last_record, on_time_percentage, total_trips, {AS_OF} AS timestamp,
               CASE WHEN degraded_sources > 0 THEN 'degraded' ELSE 'healthy' END AS status
        FROM (SELECT count(*) AS sources, count(*) FILTER (consecutive_failures >= 5) AS degraded_sources,
                     sum(records_processed)::BIGINT AS records_processed FROM ({INGESTION})) i,
             (SELECT count(*) AS n, ({LATE})*100.0::DOUBLE/count(*) AS share, max(timestamp) AS last_record,
                     (SELECT count(*) FROM v_alerts) AS total_alerts FROM v_predictions),
             (SELECT (count(*) - {LATE})*100.0::DOUBLE/count(*) AS on_time_percentage,
                     count(*) AS total_trips FROM {P})""", log=LOG),
    "kpi_snapshot": sql(f"""
        SELECT 'service_health' AS kind, {AS_OF} AS as_of, total_predictions, {STATUS} AS service_status
        FROM (SELECT count(*) AS total_predictions, ({LATE})*100.0::DOUBLE/count(*) AS share,
                     (SELECT count(*) FROM v_alerts) AS total_alerts FROM v_predictions)"""),
}
