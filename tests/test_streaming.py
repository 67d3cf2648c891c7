"""Streams against their batch counterparts, late rows, restarts and several batches."""

import datetime as dt
import json
import time

import pytest

from tramline.operators.headway import ticks
from tramline.sinks import store
from tramline.sources import feeds
from tramline.sources.tables import read_table
from tramline.plans import analytics
from tramline.streaming import headway, ingest, kpis, monitor, summary

T0 = dt.datetime(2024, 3, 1, 8)
MIN = dt.timedelta(minutes=1)
P = "id bigint, route_id string, trip_id string, stop_id string, arrival_time timestamp, delay int, timestamp timestamp"
V = "id bigint, vehicle_id string, route_id string, direction_id int, speed double, timestamp timestamp"


class Landing:
    """A folder that files are dropped into, one micro-batch per file."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.files = spark, str(folder), schema, 0

    def drop(self, *rows):
        self.files += 1
        self.spark.createDataFrame(list(rows), self.schema).coalesce(1).write.mode("append").parquet(self.folder)
        time.sleep(0.05)

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.folder)


@pytest.fixture
def run(spark, tmp_path):
    def go(stream, label="out", mode="append"):
        ingest.run_to_table(stream, str(tmp_path / label), str(tmp_path / f"{label}-cp"), mode)
        return spark.read.schema(stream.schema).parquet(str(tmp_path / label))
    return go


def pred(i, minute, delay=60, trip="t", arrival=None):
    return (i, "Red", trip, "s", arrival, delay, T0 + minute * MIN)


def pos(i, minute, route="Red", vehicle="v"):
    return (i, vehicle, route, 0, 1.0, T0 + minute * MIN)


def test_hourly_delays_drop_late_rows(spark, tmp_path, run):
    land = Landing(spark, tmp_path / "in", P)
    land.drop(pred(1, 5), pred(2, 10, None))
    land.drop(pred(3, 200))
    land.drop(pred(5, 205))
    land.drop(pred(4, 7))
    land.drop(pred(6, 400))
    rows = {r.hour_bucket: r for r in run(kpis.hourly_delays(land.stream(), "60 minutes")).collect()}
    first = rows[T0]
    assert (first.total_predictions, first.delayed_count, first.avg_delay_minutes) == (2, 1, 1.0)
    assert (first.active_routes_estimate, first.active_stops_estimate) == (1, 1)
    assert rows[T0 + 180 * MIN].total_predictions == 2 and T0 + 360 * MIN not in rows


def test_trailing_measures(spark, tmp_path, run):
    land = Landing(spark, tmp_path / "in", P)
    land.drop(pred(1, 20), pred(2, 40, -5))
    land.drop(pred(3, 600))
    rows = {r.window_start: r for r in run(kpis.trailing_measures(land.stream(), "0 seconds")).collect()}
    assert rows[T0].total_predictions == 2 and rows[T0].on_time_percentage == 50.0
    assert rows[T0 + 30 * MIN].total_predictions == 1


def test_sessions(spark, tmp_path, run):
    land = Landing(spark, tmp_path / "in", V)
    land.drop(pos(1, 0), pos(2, 20))
    land.drop(pos(3, 45), pos(4, 100))
    land.drop(pos(5, 400))
    rows = sorted(run(kpis.vehicle_sessions(land.stream(), "0 seconds")).collect(), key=lambda r: r.session_start)
    assert [(r.session_start, r.session_end, r.reports) for r in rows] == [
        (T0, T0 + 75 * MIN, 3), (T0 + 100 * MIN, T0 + 130 * MIN, 1)]


def test_dedupe_over_batches(spark, tmp_path, run):
    land = Landing(spark, tmp_path / "in", P)
    land.drop(*[pred(i, 0) for i in range(40)], pred(50, 1, arrival=T0))
    land.drop(*[pred(i, 2) for i in range(60, 90)], pred(91, 2, trip="u"))
    got = run(kpis.dedupe(land.stream(), "2 hours"))
    assert got.columns == [f.split()[0] for f in P.split(", ")]
    assert sorted((r.trip_id, r.arrival_time is None) for r in got.collect()) == [
        ("t", False), ("t", True), ("u", True)]


def test_running_totals(spark, tmp_path, run):
    land = Landing(spark, tmp_path / "in", P)
    land.drop(pred(1, 0), pred(2, 5))
    land.drop(pred(3, 2))
    stream = land.stream().selectExpr("'prediction' AS record_type", "timestamp")
    assert [tuple(r) for r in run(kpis.running_totals(stream), mode="complete").collect()] == [
        ("prediction", 3, T0, T0 + 5 * MIN)]


def test_headways_over_batches_equal_batch(spark, tmp_path, run):
    land = Landing(spark, tmp_path / "in", V)
    land.drop(pos(1, 3), pos(2, 1), pos(3, 1), pos(4, 2, "Blue"))
    land.drop(pos(5, 2.5), pos(6, 8), pos(7, 30, "Blue"))
    land.drop(pos(8, 45), pos(9, 41))
    land.drop(pos(10, 300))
    got = run(headway.live_headways(land.stream(), "10 minutes"))
    seen = {(r.route_id, r.timestamp): (r.reports, r.headway_seconds) for r in got.collect()}
    batch = sorted(ticks(spark.read.schema(V).parquet(str(tmp_path / "in"))).collect(),
                   key=lambda r: (r.route_id, r.timestamp))
    want, last = {}, {}
    for r in batch:
        before = last.get(r.route_id)
        want[(r.route_id, r.timestamp)] = (r.reports, before and (r.timestamp - before).total_seconds())
        last[r.route_id] = r.timestamp
    want.pop(("Red", T0 + 300 * MIN))
    assert seen == want


def rest(i, delay=60):
    ref = lambda x: {"data": {"id": x}}
    return json.dumps({"id": f"p{i}", "type": "prediction", "attributes": {"delay": delay},
                       "relationships": {"stop": ref(f"s{i}"), "trip": ref("t"), "route": ref("Red")}})


def test_ingest_restarts_without_duplicates(spark, tmp_path):
    root, landed, checkpoint = (str(tmp_path / x) for x in ("store", "landed", "cp"))
    store.initialise(spark, root)
    write = lambda *docs: spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).write.mode(
        "append").text(landed)
    def start():
        lines = feeds.text_lines(spark, landed, streaming=True)
        ingest.start_ingest(lines, root, checkpoint, "rest", as_of=T0, trigger={"availableNow": True}).awaitTermination()
        return read_table(spark, root, "predictions").count()
    write(rest(1), rest(2), rest(3, 9999))
    assert start() == 2
    assert start() == 2
    write(rest(2), rest(4))
    assert start() == 3
    assert spark.read.parquet(f"{root}/quarantine").count() == 1
    log = [r.batch_id for r in read_table(spark, root, "data_ingestion_logs").collect()]
    assert len(log) == len(set(log)) == 4 and len({i.rsplit("-", 2)[0] for i in log}) == 1 and all(i.startswith("rest-") for i in log)


def test_two_streams_of_one_form_stay_apart(spark, tmp_path):
    root = str(tmp_path / "store")
    store.initialise(spark, root)
    when = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    place = lambda i: json.dumps({"id": f"v{i}", "type": "vehicle", "attributes": {"latitude": 42.35, "longitude": -71.05, "updated_at": str(when)}})
    for name, cars in (("north", (1, 2)), ("south", (3,))):
        spark.createDataFrame([(place(i),) for i in cars], "value string").write.text(str(tmp_path / name))
        for again in ("a", "a", "b"):
            lines = feeds.text_lines(spark, str(tmp_path / name), streaming=True)
            ingest.start_ingest(lines, root, str(tmp_path / f"cp-{name}-{again}"), "feed", as_of=T0, trigger={"availableNow": True}).awaitTermination()
    # Two streams of one name, each begun anew once: every start with a checkpoint of its own is a stream of its own.
    stored = read_table(spark, root, "vehicle_positions")
    assert sorted(r.vehicle_id for r in stored.collect()) == ["v1", "v1", "v2", "v2", "v3", "v3"]


def test_refresh_runs_per_batch(spark, tmp_path):
    land = Landing(spark, tmp_path / "in", P)
    land.drop(pred(1, 0))
    seen = []
    query = ingest.start_refresh(land.stream(), seen.append, str(tmp_path / "cp"), "100 milliseconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert seen[:1] == [0]


def test_monitor_counts_and_failures(spark, tmp_path):
    watch = monitor.IngestMonitor()
    spark.streams.addListener(watch)
    try:
        land = Landing(spark, tmp_path / "in", P)
        land.drop(pred(1, 0), pred(2, 0))
        def start(each, label):
            return (land.stream().writeStream.queryName(label).foreachBatch(each)
                    .option("checkpointLocation", str(tmp_path / label)).trigger(availableNow=True).start())
        def fail(batch, number):
            raise ValueError("no")
        start(lambda b, n: b.count(), "good").awaitTermination()
        with pytest.raises(Exception):
            start(fail, "bad").awaitTermination()
        for _ in range(100):
            report = {r["name"]: r for r in watch.report()}
            if report.get("bad", {}).get("errors") and report.get("good", {}).get("records"):
                break
            time.sleep(0.1)
        assert report["good"]["records"] == 2 and not report["good"]["stalled"]
        assert report["bad"]["errors"] == 1 and report["bad"]["status"] == "healthy"
        assert watch.report(now=time.time() + 1000)[1]["stalled"]
    finally:
        spark.streams.removeListener(watch)


def test_live_cards_of_three_streams(spark, tmp_path):
    """Each window has all three cards, also where a stream was silent, over several batches and with own watermarks."""
    predictions = spark.createDataFrame([pred(1, 5), pred(2, 8, None), pred(3, 9, -30), pred(4, 130, 90)], P)
    positions = spark.createDataFrame(
        [("a", 1, 1.25, T0), ("a", 0, 2.0, T0 + MIN), ("b", None, None, T0 + MIN), (None, 3, 4.0, T0 + 130 * MIN)],
        "vehicle_id string, congestion_level int, speed double, timestamp timestamp")
    alerts = spark.createDataFrame([("x", "high", T0 + 130 * MIN), ("y", None, T0 + 131 * MIN)], "id string, alert_severity_level string, timestamp timestamp")
    sources = {"predictions": predictions, "positions": positions, "alerts": alerts}
    for cuts in ((), (T0 + 60 * MIN,)):
        got = ingest.run_in_parts(spark, sources, lambda s: kpis.live_windows(**s), str(tmp_path / f"run{len(cuts)}"), cuts)
        rows = {(r.window_start, r.data_type): tuple(r)[3:] for r in got.collect()}
        assert len(rows) == got.count() == 24
        assert [rows[T0, k] for k in ("predictions", "vehicles", "alerts")] == [(3, 1, 0.33), (2, 1, 1.63), (0, 0, 0.0)]
        later = T0 + 120 * MIN
        assert [rows[later, k] for k in ("predictions", "vehicles", "alerts")] == [(1, 1, 1.5), (0, 1, 4.0), (2, 1, 0.0)]


def test_a_run_in_parts_is_the_whole_result(spark, tmp_path):
    """What is open when the source has run dry comes out as well, and the operators' own watermarks drop nothing."""
    rows = [pos(i, 7 * i, vehicle=f"v{i % 3}") for i in range(90)]
    df = spark.createDataFrame(rows, V)
    one, two = (ingest.run_in_parts(
        spark, {"p": df}, lambda s: kpis.vehicle_sessions(s["p"]), str(tmp_path / f"x{len(cuts)}"), cuts) for cuts in ((), (T0 + 200 * MIN, T0 + 400 * MIN)))
    key = lambda frame: sorted((r.vehicle_id, r.session_start, r.session_end, r.reports) for r in frame.collect())
    assert key(one) == key(two) and sum(r[3] for r in key(one)) == 90
    none = spark.createDataFrame([], V)
    assert ingest.run_in_parts(spark, {"p": none}, lambda s: kpis.vehicle_sessions(s["p"]), str(tmp_path / "none")).count() == 0


def test_kept_summary_equals_the_batch_report(spark, tmp_path):
    root = str(tmp_path / "store")
    store.initialise(spark, root)
    land = Landing(spark, tmp_path / "in", P)
    land.drop(pred(1, 5), pred(2, 70, None), pred(3, 9, -30))
    land.drop(pred(4, 7, 400), pred(5, 130, 90))
    for _ in range(2):
        summary.start_summary(land.stream(), root, str(tmp_path / "cp"), "kept", {"availableNow": True}).awaitTermination()
    routes = spark.createDataFrame([("Red", "Red Line")], "id string, route_name string")
    now = T0 + 300 * MIN
    rows = spark.read.schema(P).parquet(str(tmp_path / "in"))
    want = [tuple(r) for r in analytics.performance(rows, routes, now, 24).collect()]
    assert [tuple(r) for r in summary.kept_performance(spark, root, routes, now, 24).collect()] == want
    # The same batch once more, with the checkpoint lost half-way: nothing is added.
    assert summary.add_batch(rows, root, "again") > 0 and summary.add_batch(rows, root, "again") == 0


def test_a_feed_that_falls_silent_is_found_by_the_others(spark, tmp_path, run):
    log = "source_type string, status string, records_processed bigint, completed_at timestamp"
    row = lambda source, minute, n=5, status="success": (source, status, n, T0 + minute * MIN)
    land = Landing(spark, tmp_path / "in", log)
    land.drop(row("rest", 0), row("feed", 0), row("rest", 10))
    land.drop(row("feed", 12), row("rest", 14, 0), row("rest", 15, 3, "error"), row("feed", 24))
    land.drop(row("feed", 36), row("feed", 48))
    land.drop(row("rest", 50), row("feed", 58))
    got = run(monitor.feed_stalls(land.stream(), "15 minutes", "2 minutes"))
    assert sorted((r.source_type, r.state, (r.since - T0).total_seconds() / 60, r.runs, r.records) for r in got.collect()) == [
        ("rest", "active", 0, 2, 10), ("rest", "stalled", 25, 2, 10)]
