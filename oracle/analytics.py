"""SQL of the twelve named reports."""

from oracle.views import LATE, POS, mins, pct, r2, spine, sql, window

P, V, A = window("v_predictions"), window("v_vehicle_positions"), window("v_alerts")

# The mean of whole cm/s in m/s, halves up at two decimals, in whole-number arithmetic.
SPEED = "((2*sum(speed_cms) + count(speed_cms)) // nullif(2*count(speed_cms), 0)) / 100.0::DOUBLE"

QUERIES = {
    "q_performance": sql(f"""
        SELECT p.route_id, r.route_name, count(*) AS total_predictions, {LATE} AS delayed_predictions,
               count(*) FILTER (delay > 300) AS severely_delayed,
               {pct(f'count(*) - {LATE}', 'count(*)')} AS on_time_percentage,
               {mins(f'sum({POS})', 'count(*)')} AS avg_delay_minutes,
               {r2(f'stddev_samp({POS})/60.0::DOUBLE')} AS delay_std_dev_minutes,
               {mins('sum(delay)', 'count(delay)')} AS overall_avg_delay_minutes
        FROM {P} p JOIN v_routes r ON p.route_id = r.id GROUP BY p.route_id, r.route_name"""),
    "q_delays": sql(f"""
        SELECT s.hour_bucket, coalesce(n, 0) AS total_predictions, coalesce(late, 0) AS delayed_count,
               coalesce(a, 0) AS avg_delay_minutes, coalesce(m, 0) AS max_delay_minutes,
               coalesce(pc, 0) AS delay_percentage
        FROM spine s LEFT JOIN hourly USING (hour_bucket)""",
        spine=spine(),
        hourly=f"""
        SELECT date_trunc('hour', timestamp) AS hour_bucket, count(*) AS n, {LATE} AS late,
               {mins('sum(delay)', 'count(delay)')} AS a, {r2('max(delay)/60.0::DOUBLE')} AS m,
               {pct(LATE, 'count(*)')} AS pc
        FROM {P} GROUP BY 1"""),
    "q_routes": sql(f"""
        SELECT r.id AS route_id, r.route_name, r.route_type, count(p.id) AS total_predictions,
               {LATE} AS delayed_predictions,
               {pct(f'count(p.id) - {LATE}', 'count(p.id)')} AS on_time_percentage,
               {mins(f'sum({POS})', 'count(*)')} AS avg_delay_minutes,
               {r2('max(delay)/60.0::DOUBLE')} AS max_delay_minutes,
               count(DISTINCT p.trip_id) AS unique_trips, count(DISTINCT p.stop_id) AS unique_stops
        FROM v_routes r LEFT JOIN {P} p ON r.id = p.route_id GROUP BY r.id, r.route_name, r.route_type"""),
    "q_stops": sql(f"""
        SELECT s.id AS stop_id, s.stop_name, s.stop_lat, s.stop_lon, count(p.id) AS total_predictions,
               {LATE} AS delayed_predictions,
               {pct(f'count(p.id) - {LATE}', 'count(p.id)')} AS on_time_percentage,
               {mins(f'sum({POS})', 'count(*)')} AS avg_delay_minutes,
               trunc(max(delay)/60.0::DOUBLE)::BIGINT AS max_delay_minutes
        FROM v_stops s JOIN {P} p ON s.id = p.stop_id
        GROUP BY s.id, s.stop_name, s.stop_lat, s.stop_lon HAVING count(p.id) >= 5"""),
    "q_vehicles": sql(f"""
        SELECT s.hour_bucket, coalesce(n, 0) AS vehicle_count, coalesce(c, 0) AS congested_count,
               coalesce(a, 0) AS avg_speed_mps, coalesce(mx, 0) AS max_speed_mps,
               coalesce(mn, 0) AS min_speed_mps,
               CASE WHEN n IS NULL THEN 'No Data' WHEN n = 0 THEN 'No Vehicles'
                    WHEN n < 10 THEN 'Low Activity' WHEN n < 50 THEN 'Normal Activity'
                    ELSE 'High Activity' END AS activity_level
        FROM spine s LEFT JOIN hourly USING (hour_bucket)""",
        spine=spine(),
        hourly=f"""
        SELECT date_trunc('hour', timestamp) AS hour_bucket, count(DISTINCT vehicle_id) AS n,
               count(*) FILTER (congestion_level > 0) AS c,
               {SPEED} AS a,
               {r2('max(speed_cms)/100.0::DOUBLE')} AS mx, {r2('min(speed_cms)/100.0::DOUBLE')} AS mn
        FROM {V} GROUP BY 1"""),
    "q_alerts": sql(f"""
        SELECT alert_effect, alert_severity_level, count(*) AS alert_count,
               count(DISTINCT list_sort(affected_route_ids)) AS affected_routes,
               count(DISTINCT list_sort(affected_stop_ids)) AS affected_stops,
               min(timestamp) AS first_alert, max(timestamp) AS last_alert,
               {r2('(epoch_us(max(timestamp)) - epoch_us(min(timestamp)))/3600000000.0::DOUBLE')}
                   AS duration_hours
        FROM {A} GROUP BY ALL"""),
    "q_headways": sql(f"""
        SELECT h.route_id, r.route_name, h.direction_id, count(*) AS total_headways,
               {r2('avg(s)/60.0::DOUBLE')} AS avg_headway_minutes,
               {r2('stddev_samp(s)/60.0::DOUBLE')} AS headway_std_dev_minutes,
               {r2('min(s)/60.0::DOUBLE')} AS min_headway_minutes,
               {r2('max(s)/60.0::DOUBLE')} AS max_headway_minutes,
               count(*) FILTER (s < 180) AS bunching_incidents, count(*) FILTER (s > 900) AS gap_incidents
        FROM h JOIN v_routes r ON h.route_id = r.id WHERE s IS NOT NULL
        GROUP BY h.route_id, r.route_name, h.direction_id HAVING count(*) >= 5""",
        h=f"""
        SELECT route_id, direction_id,
               (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (
                   PARTITION BY route_id, direction_id ORDER BY timestamp, id)))/1000000.0::DOUBLE AS s
        FROM {V}"""),
    "q_peak": sql(f"""
        SELECT CASE WHEN h BETWEEN 7 AND 9 THEN 'Morning Peak (7-9 AM)'
                    WHEN h BETWEEN 16 AND 18 THEN 'Evening Peak (4-6 PM)'
                    WHEN h BETWEEN 10 AND 15 THEN 'Midday (10 AM-3 PM)'
                    WHEN h BETWEEN 19 AND 22 THEN 'Evening (7-10 PM)'
                    ELSE 'Late Night (11 PM-6 AM)' END AS time_period,
               count(*) AS total_predictions, {LATE} AS delayed_predictions,
               {pct(f'count(*) - {LATE}', 'count(*)')} AS on_time_percentage,
               {mins(f'sum({POS})', 'count(*)')} AS avg_delay_minutes,
               {r2('max(delay)/60.0::DOUBLE')} AS max_delay_minutes
        FROM (SELECT *, extract(hour FROM timestamp) AS h FROM {P}) GROUP BY 1"""),
    "q_anomalies": sql(f"""
        SELECT * FROM (
            SELECT CASE WHEN delay > a + 3*s THEN 'Extreme Delay' WHEN delay > a + 2*s THEN 'High Delay'
                        WHEN delay < a - 2*s THEN 'Early Arrival' ELSE 'Normal' END AS anomaly_type,
                   count(*) AS count, {mins('sum(delay)', 'count(*)')} AS avg_delay_minutes,
                   trunc(max(delay)/60.0::DOUBLE)::BIGINT AS max_delay_minutes,
                   count(DISTINCT route_id) AS affected_routes,
                   min(timestamp) AS first_occurrence, max(timestamp) AS last_occurrence
            FROM {P} JOIN stats USING (route_id) WHERE delay IS NOT NULL AND s > 0 GROUP BY 1)
        WHERE anomaly_type <> 'Normal'""",
        stats=f"""
        SELECT route_id, avg(delay) AS a, stddev_samp(delay) AS s
        FROM {P} WHERE delay IS NOT NULL GROUP BY route_id"""),
    "q_realtime": sql(f"""
        SELECT 'predictions' AS data_type, count(*) AS count, {LATE} AS delayed_count,
               {mins(f'sum({POS})', 'count(*)')} AS avg_delay_minutes FROM {window('v_predictions', 1)}
        UNION ALL
        SELECT 'vehicles', count(DISTINCT vehicle_id), count(*) FILTER (congestion_level > 0),
               {SPEED} FROM {window('v_vehicle_positions', 1)}
        UNION ALL
        SELECT 'alerts', count(*), count(*) FILTER (alert_severity_level = 'high'), 0.0::DOUBLE
        FROM {window('v_alerts', 1)}"""),
    "q_geographic": sql(f"""
        SELECT CASE WHEN stop_lat BETWEEN 42.35::DOUBLE AND 42.37::DOUBLE
                         AND stop_lon BETWEEN -71.07::DOUBLE AND -71.05::DOUBLE THEN 'Downtown Boston'
                    WHEN stop_lat BETWEEN 42.33::DOUBLE AND 42.35::DOUBLE
                         AND stop_lon BETWEEN -71.05::DOUBLE AND -71.03::DOUBLE THEN 'Cambridge'
                    WHEN stop_lat BETWEEN 42.37::DOUBLE AND 42.39::DOUBLE
                         AND stop_lon BETWEEN -71.05::DOUBLE AND -71.03::DOUBLE THEN 'Somerville'
                    WHEN stop_lat BETWEEN 42.31::DOUBLE AND 42.33::DOUBLE
                         AND stop_lon BETWEEN -71.03::DOUBLE AND -71.01::DOUBLE THEN 'Brookline'
                    ELSE 'Other Areas' END AS geographic_area,
               count(*) AS total_predictions, {LATE} AS delayed_predictions,
               {pct(f'count(*) - {LATE}', 'count(*)')} AS on_time_percentage,
               {mins(f'sum({POS})', 'count(*)')} AS avg_delay_minutes,
               count(DISTINCT p.route_id) AS unique_routes, count(DISTINCT p.stop_id) AS unique_stops
        FROM {P} p JOIN v_stops s ON p.stop_id = s.id
        WHERE stop_lat IS NOT NULL AND stop_lon IS NOT NULL GROUP BY 1"""),
    "q_hourly_trends": sql(f"""
        SELECT s.hour_bucket, coalesce(n, 0) AS total_predictions, coalesce(late, 0) AS delayed_count,
               coalesce(a, 0) AS avg_delay_minutes, coalesce(m, 0) AS max_delay_minutes,
               coalesce(ar, 0) AS active_routes, coalesce(ast, 0) AS active_stops,
               CASE WHEN n IS NULL THEN 'No Data' WHEN n = 0 THEN 'No Activity'
                    WHEN late::DOUBLE/n::DOUBLE > 0.3::DOUBLE THEN 'High Delays'
                    WHEN late::DOUBLE/n::DOUBLE > 0.1::DOUBLE THEN 'Moderate Delays'
                    ELSE 'Good Performance' END AS performance_status
        FROM spine s LEFT JOIN hourly USING (hour_bucket)""",
        spine=spine(),
        hourly=f"""
        SELECT date_trunc('hour', timestamp) AS hour_bucket, count(*) AS n, {LATE} AS late,
               {mins(f'sum({POS})', 'count(*)')} AS a, {r2('max(delay)/60.0::DOUBLE')} AS m,
               count(DISTINCT route_id) AS ar, count(DISTINCT stop_id) AS ast
        FROM {P} GROUP BY 1"""),
}

# The reports that can be asked for one route, over its facts alone.
ONE_ROUTE = ["performance", "delays", "stops", "headways", "hourly_trends"]
for _name in ONE_ROUTE:
    _text = QUERIES[f"q_{_name}"]
    for _facts in (P, V):
        _text = _text.replace(_facts, f"{_facts[:-1]} AND route_id = 'Red')")
    QUERIES[f"q_{_name}_one_route"] = _text
