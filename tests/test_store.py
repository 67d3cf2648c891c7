"""The store: repeats change nothing, null keys are equal, missing references are filled."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tramline.operators import upsert
from tramline.operators.flatten import conform
from tramline.plans import health
from tramline.sinks import commits, publish, store
from tramline.operators.topk import newest
from tramline.sources.tables import SEED_ROUTES, read_newest, read_table, seeded
from tramline.streaming.ingest import IngestError, process_batch

NOW = dt.datetime(2024, 3, 1, 12)
KEYS = ["trip_id", "stop_id", "arrival_time"]
ROW = "id int, trip_id string, stop_id string, arrival_time timestamp, delay int"


def rows(spark, *data):
    return spark.createDataFrame(list(data), ROW)


def test_first_write_wins_and_nulls_are_equal(spark):
    batch = rows(spark, (2, "t", "s", None, 20), (1, "t", "s", None, 10), (3, "t", "s", NOW, 30), (4, None, "s", NOW, 1),
                 (5, None, "s", NOW, 2))
    firsts = upsert.first_per_key(batch, KEYS, "id")
    assert {(r.id, r.delay) for r in firsts.collect()} == {(1, 10), (3, 30), (4, 1)}
    target = rows(spark, (9, "t", "s", None, 99))
    added = upsert.new_rows(batch, target, KEYS, "id")
    assert {r.id for r in added.collect()} == {3, 4}
    merged = upsert.merge_absent(batch, target, KEYS, "id")
    assert {r.id for r in merged.collect()} == {9, 3, 4}
    assert upsert.new_rows(batch, merged, KEYS, "id").count() == 0


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    batch = spark.range(0, 20000, numPartitions=4).selectExpr(
        "cast(id as int) id", "case when id % 3 = 0 then 'hot' else concat('t', id) end trip_id", "'s' stop_id",
        "cast(null as timestamp) arrival_time", "0 delay")
    out = upsert.first_per_key(batch, KEYS, "id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan
    assert out.count() == 20000 - 6667 + 1 and out.where("trip_id = 'hot'").first().id == 0


def predictions(spark, *data):
    df = spark.createDataFrame(
        [(p, t, s, r, a, v, d) for p, t, s, r, a, v, d in data],
        "prediction_id string, trip_id string, stop_id string, route_id string, arrival_time timestamp, "
        "vehicle_id string, delay int")
    return conform(df.withColumns({"schedule_relationship": F.lit("scheduled"), "vehicle_label": F.lit("L")}), "prediction")


def counts(spark, root, *names):
    return {n: read_table(spark, root, n).count() for n in names}


@pytest.fixture
def root(spark, tmp_path):
    store.initialise(spark, str(tmp_path / "store"))
    return str(tmp_path / "store")


def test_store_is_idempotent_and_repairs_references(spark, root):
    df = predictions(
        spark, ("p1", "t1", "s1", "Red", NOW, "v1", 60), ("p2", "t1", "s1", "Red", NOW, "v1", 90),
        ("p3", "t1", "s1", "Red", None, None, 0), ("p4", "t2", "s2", "Mattapan", NOW, "v2", None))
    first = store.store(df, "prediction", root, "1", NOW)
    assert (first["status"], first["processed"], first["inserted"]) == ("success", 4, 3)
    again = store.store(df, "prediction", root, "1", NOW)
    assert (again["status"], again["inserted"], again["error"]) == ("success", 0, None)
    assert counts(spark, root, "predictions", "stops", "trips", "vehicles", "routes") == {
        "predictions": 3, "stops": 2, "trips": 2, "vehicles": 2, "routes": len(SEED_ROUTES) + 2}
    trip = read_table(spark, root, "trips").first()
    assert (trip.route_id, trip.service_id) == ("unknown", "unknown")
    assert read_table(spark, root, "routes").where("id = 'Mattapan'").first().route_name == "Route Mattapan"
    assert read_table(spark, root, "routes").where("id = 'unknown'").count() == 1
    row = read_table(spark, root, "predictions").where("delay = 60 OR delay = 90").first()
    assert row.schedule_relationship == 0 and row.timestamp == NOW and row.arrival_date == "2024-03-01"
    assert {r.arrival_date for r in read_table(spark, root, "predictions").collect()} == {"2024-03-01", "none"}
    log = read_table(spark, root, "data_ingestion_logs").collect()
    assert [(r.source_type, r.status, r.records_processed) for r in log] == [("prediction", "success", 4)]
    assert health.ingestion_health(read_table(spark, root, "data_ingestion_logs")).first().status == "healthy"


def test_vehicles_are_not_seeded_when_turned_off(spark, root):
    store.store(predictions(spark, ("p", "t", "s", "Red", NOW, "v1", 1)), "prediction", root, "1", NOW, seed_missing=False)
    assert counts(spark, root, "vehicles") == {"vehicles": 0}


def test_append_only_tables_take_a_batch_once(spark, root):
    df = conform(spark.createDataFrame(
        [("v1", "Red", 42.3, -71.0, "low", NOW), ("v1", "Red", 42.3, -71.0, "low", NOW)],
        "vehicle_id string, route_id string, latitude double, longitude double, congestion_level string, "
        "timestamp timestamp"), "vehicle_position")
    for batch, added in (("1", 2), ("1", 0), ("2", 2)):
        assert store.store(df, "vehicle_position", root, batch, NOW)["inserted"] == added
    stored = read_table(spark, root, "vehicle_positions")
    assert stored.count() == 4 and stored.first().congestion_level == 1
    day = read_table(spark, root, "vehicle_positions", as_of=NOW, hours=1)
    assert "PartitionFilters: [isnotnull(partition_date" in day._jdf.queryExecution().toString()
    assert day.count() == 4


def test_an_error_is_logged_and_the_rest_is_stored(spark, root):
    good = predictions(spark, ("p", "t", "s", "Red", NOW, "v", 1))
    broken = good.withColumn("delay", F.raise_error(F.lit("bad feed")).cast("int"))
    stop = conform(spark.createDataFrame([("s", "Park")], "stop_id string, stop_name string"), "stop")
    result = store.store_all({"prediction": broken, "stop": stop}, root, "1", NOW)
    assert result["status"] == "partial" and "bad feed" in result["by_type"]["prediction"]["error"]
    statuses = {r.source_type: r.status for r in read_table(spark, root, "data_ingestion_logs").collect()}
    assert statuses == {"prediction": "error", "stop": "success"}
    with pytest.raises(ValueError):
        store.store(good, "nonsense", root)


def test_alerts_trips_and_updates(spark, root):
    alert = conform(spark.createDataFrame(
        [("a", ["Red"], "DETOUR", NOW), ("a", ["Blue"], "DELAY", NOW)],
        "alert_id string, affected_routes array<string>, effect string, effective_start_date timestamp"), "alert")
    trip = conform(spark.createDataFrame([("t", "New")], "trip_id string, route_id string"), "trip")
    update = conform(spark.createDataFrame([("t", "Red", 12.5, NOW)],
                                           "trip_id string, route_id string, delay double, timestamp timestamp"), "trip_update")
    assert store.store_all({"alert": alert, "trip": trip, "trip_update": update}, root, "1", NOW)["status"] == "success"
    assert counts(spark, root, "alerts", "trips", "trip_updates") == {"alerts": 1, "trips": 1, "trip_updates": 1}
    assert read_table(spark, root, "routes").where("id = 'New'").count() == 1
    row = read_table(spark, root, "alerts").first()
    assert row.active_period_start == NOW and row.alert_effect in ("DETOUR", "DELAY")


def test_seed_only_into_an_empty_store(spark, root):
    routes = read_table(spark, root, "routes")
    assert routes.count() == 8 and store.initialise(spark, root) == 0
    assert seeded(routes).count() == 0 and seeded(routes.where("false")).count() == 8


def test_process_batch_puts_bad_input_in_quarantine(spark, root):
    soon = (NOW + dt.timedelta(minutes=5)).isoformat() + "Z"
    ref = lambda i: {"data": {"id": i}}
    good = {"id": "p", "type": "prediction", "attributes": {"arrival_time": soon, "delay": 60},
            "relationships": {"stop": ref("s"), "trip": ref("t"), "route": ref("Red")}}
    late = {**good, "id": "q", "attributes": {"delay": 9999}}
    lines = spark.createDataFrame(
        [(json.dumps(d),) for d in (good, late, {"id": "x", "type": "alert"})] + [("{not json",)], "value string")
    for settled in (False, True):
        assert process_batch(lines, "b1", root, as_of=NOW, settled=settled)["status"] == "success"
    assert counts(spark, root, "predictions") == {"predictions": 1}
    log = read_table(spark, root, "data_ingestion_logs").where("source_type = 'prediction'").first()
    assert (log.records_processed, log.records_failed) == (1, 1)
    refused = {r.reject_reasons[0]: r.payload for r in spark.read.parquet(f"{root}/quarantine").collect()}
    assert set(refused) == {"delay_out_of_range", "unknown_type", "undecodable"}
    assert refused == {"delay_out_of_range": json.dumps(late), "unknown_type": json.dumps({"id": "x", "type": "alert"}),
                       "undecodable": "{not json"}


def test_a_failed_write_fails_the_batch_and_a_replay_stores_it(spark, root, monkeypatch):
    ref = lambda i: {"data": {"id": i}}
    doc = {"id": "p", "type": "prediction", "attributes": {"delay": 60}, "relationships": {"stop": ref("s"), "trip": ref("t"), "route": ref("Red")}}
    lines = spark.createDataFrame([(json.dumps(doc),)], "value string")
    insert = store.insert_absent
    def broken(rows, root, table, *order):
        if table == "predictions":
            raise OSError("disk")
        return insert(rows, root, table, *order)
    monkeypatch.setattr(store, "insert_absent", broken)
    with pytest.raises(IngestError) as fault:
        process_batch(lines, "b", root, as_of=NOW)
    assert fault.value.outcome["by_type"]["prediction"]["error"] == "disk"
    assert counts(spark, root, "predictions") == {"predictions": 0}
    monkeypatch.setattr(store, "insert_absent", insert)
    process_batch(lines, "b", root, as_of=NOW)
    assert counts(spark, root, "predictions") == {"predictions": 1}
    statuses = sorted(r.status for r in read_table(spark, root, "data_ingestion_logs").where("source_type = 'prediction'").collect())
    assert statuses == ["error", "success"]


@pytest.mark.parametrize("form, doc, reason", [
    ("rest", {"id": "w", "type": "prediction", "attributes": {"arrival_time": "1709280000000000000"}}, "wild_time"),
    ("rest", {"id": "w", "type": "prediction", "attributes": {"delay": 12.5}}, "bad_delay"),
    ("rest", {"id": "w", "type": "shape", "attributes": {"new": [1, 2]}}, "unknown_type"),
    ("loose", {"vehicle_id": "v", "latitude": 42.3, "longitude": -71.0, "timestamp": "99999999999999999999"}, "wild_time"),
    ("feed", {"header": {"timestamp": 1709280000}, "entity": [{"id": "e", "vehicle": {"timestamp": 1709280000000000000}}]}, "wild_time"),
])
def test_refused_lines_are_kept_as_they_came(spark, root, form, doc, reason):
    line = json.dumps(doc)
    process_batch(spark.createDataFrame([(line,)], "value string"), "b", root, form, as_of=NOW)
    rows = read_table(spark, root, "quarantine").collect()
    assert [r.reject_reasons for r in rows] == [[reason]]
    assert rows[0].payload == line or form == "feed" and json.loads(rows[0].payload)["vehicle"]["timestamp"] == 1709280000000000000


def test_a_response_document_gives_its_records(spark, root):
    ref = lambda i: {"data": {"id": i}}
    record = lambda i: {"id": f"p{i}", "type": "prediction", "attributes": {"delay": i},
                        "relationships": {"stop": ref("s"), "trip": ref(f"t{i}"), "route": ref("Red")}}
    lines = spark.createDataFrame([(json.dumps({"data": [record(1), record(2)]}),), (json.dumps(record(3)),)], "value string")
    process_batch(lines, "b", root, as_of=NOW)
    assert {r.trip_id for r in read_table(spark, root, "predictions").collect()} == {"t1", "t2", "t3"}


def test_the_first_to_arrive_is_kept(spark, root, tmp_path):
    from tramline.sources.feeds import text_lines

    ref = lambda i: {"data": {"id": i}}
    doc = lambda delay: json.dumps({"id": "p", "type": "prediction", "attributes": {"delay": delay},
                                    "relationships": {"stop": ref("s"), "trip": ref("t"), "route": ref("Red")}})
    (tmp_path / "landed").mkdir()
    (tmp_path / "landed" / "one.json").write_text(doc(900) + "\n" + doc(60) + "\n")
    process_batch(text_lines(spark, str(tmp_path / "landed")), "b", root, as_of=NOW)
    row = read_table(spark, root, "predictions").first()
    assert (row.delay, row.batch_id, row.source, row.processed_at) == (900, "b", "prediction", NOW)


def test_many_batches_of_a_day_share_its_folder(spark, root):
    import glob

    df = conform(spark.createDataFrame([("v1", 42.3, -71.0, NOW)], "vehicle_id string, latitude double, longitude double, timestamp timestamp"),
                 "vehicle_position")
    for n in range(8):
        store.append_once(store.table_rows(df, "vehicle_position", NOW, f"b{n}"), root, "vehicle_positions", f"b{n}")
    assert store.append_once(store.table_rows(df, "vehicle_position", NOW, "b3"), root, "vehicle_positions", "b3") == 0
    assert len(glob.glob(f"{root}/vehicle_positions/*=*")) == 1
    store.compact_day(spark, root, "vehicle_positions", "2024-03-01")
    assert len(glob.glob(f"{root}/vehicle_positions/*=*/*.parquet")) == 1
    assert read_table(spark, root, "vehicle_positions").count() == 8


def test_topics_and_exports(spark, tmp_path):
    df = spark.createDataFrame([("p1", None, NOW), ("p2", "t", NOW)], "prediction_id string, trip_id string, arrival_time timestamp")
    sent = publish.route_messages({"prediction": df, "stop": df.withColumnRenamed("trip_id", "stop_id")})
    got = {r.key: (r.topic, json.loads(r.value)) for r in sent.collect()}
    assert set(got) == {"p1", "t"} and got["t"][0] == "transit.predictions.raw"
    assert got["p1"][1] == {"prediction_id": "p1", "trip_id": None, "arrival_time": "2024-03-01T12:00:00.000000"}
    publish.write_messages(sent, str(tmp_path / "topics"))
    assert spark.read.json(str(tmp_path / "topics")).count() == 2
    doc = spark.range(1).selectExpr("1 AS total", "named_struct('a', 2) AS part")
    publish.export(doc, str(tmp_path / "doc"))
    assert spark.read.json(str(tmp_path / "doc")).first().part.a == 2
    with pytest.raises(ValueError):
        publish.export(doc, str(tmp_path / "doc"), "xml")
    for hour in range(2):
        publish.append_snapshot(doc, "health", str(tmp_path), NOW + dt.timedelta(hours=hour))
    assert spark.read.parquet(str(tmp_path / "kpi_snapshot")).count() == 2
    publish.publish_stats({"totals": doc, "lists": doc}, str(tmp_path / "stats"))
    assert spark.read.json(str(tmp_path / "stats" / "lists")).count() == 1


def test_nothing_new_leaves_no_file(spark, root):
    import glob

    df = predictions(spark, ("p", "t", "s", "Red", NOW, "v", 1))
    files = lambda: sorted(f for f in glob.glob(f"{root}/**/*.parquet", recursive=True) if "data_ingestion_logs" not in f)
    store.store(df, "prediction", root, "1", NOW)
    before = files()
    store.store(df, "prediction", root, "2", NOW)
    assert files() == before


def test_the_newest_rows_are_found_in_the_last_days(spark, root):
    base = predictions(spark, *[(f"p{i}", f"t{i}", "s", "Red", NOW, "v", i) for i in range(4)])
    for day in range(3):
        store.store(base.withColumn("trip_id", F.concat("trip_id", F.lit(f"-{day}"))), "prediction", root, str(day),
                    NOW + dt.timedelta(days=day))
    for n, days in ((3, 1), (4, 1), (5, 2), (99, 3)):
        rows = read_newest(spark, root, "predictions", n)
        assert rows.select("partition_date").distinct().count() == days
        want = {r.id for r in newest(read_table(spark, root, "predictions"), n).collect()}
        assert {r.id for r in newest(rows, n).collect()} == want
    assert read_newest(spark, root, "vehicle_positions", 5).count() == 0


def two_days(spark):
    """Three positions: of two days and of no day."""
    return conform(spark.createDataFrame(
        [("v1", NOW), ("v2", NOW - dt.timedelta(days=1)), ("v3", None)], "vehicle_id string, timestamp timestamp"), "vehicle_position")


def vehicles(spark, root):
    return sorted(r.vehicle_id for r in read_table(spark, root, "vehicle_positions").collect())


def test_a_batch_that_stopped_between_days_is_whole_after_a_replay(spark, root, monkeypatch):
    df, move = two_days(spark), commits.Folder.move
    moved = []

    def stopping(self, source, target):
        if "/_plans/" not in target:
            moved.append(target)
            if len(moved) == 2:
                raise OSError("the driver is gone")
        move(self, source, target)

    monkeypatch.setattr(commits.Folder, "move", stopping)
    first = store.store(df, "vehicle_position", root, "b1", NOW)
    assert first["status"] == "error" and "driver is gone" in first["error"]
    monkeypatch.setattr(commits.Folder, "move", move)
    # One file lies in the table, but no reader sees half a batch.
    assert spark.read.parquet(f"{root}/vehicle_positions").count() == 1 and vehicles(spark, root) == []
    assert store.store(df, "vehicle_position", root, "b1", NOW)["status"] == "success"
    assert vehicles(spark, root) == ["v1", "v2", "v3"]
    for _ in range(2):
        assert store.store(df, "vehicle_position", root, "b1", NOW)["inserted"] == 0
    assert vehicles(spark, root) == ["v1", "v2", "v3"]
    assert store.store(df, "vehicle_position", root, "b2", NOW)["inserted"] == 3


def test_a_batch_that_stopped_while_it_was_staged_is_staged_anew(spark, root, monkeypatch):
    df = two_days(spark)
    with monkeypatch.context() as broken:
        broken.setattr(commits.Folder, "write", lambda *_: (_ for _ in ()).throw(OSError("no plan")))
        with pytest.raises(OSError):
            store.append_once(store.table_rows(df, "vehicle_position", NOW, "b"), root, "vehicle_positions", "b")
    assert vehicles(spark, root) == []
    assert store.append_once(store.table_rows(df, "vehicle_position", NOW, "b"), root, "vehicle_positions", "b") == 3
    assert vehicles(spark, root) == ["v1", "v2", "v3"]


def test_open_plans_are_finished_when_a_store_is_opened_and_old_ones_forgotten(spark, root):
    rows = store.table_rows(two_days(spark), "vehicle_position", NOW, "b")
    write = lambda df, path: store.write_files(df, path, "vehicle_positions", "append")
    assert commits.stage(rows, root, "vehicle_positions", "b", write)
    commits.publish(spark, root, "vehicle_positions", commits.batch_name("b"), most=1)
    assert vehicles(spark, root) == []
    store.initialise(spark, root)
    assert vehicles(spark, root) == ["v1", "v2", "v3"] and not commits.unpublished(spark, root, "vehicle_positions")
    assert commits.forget(spark, root, "vehicle_positions", 1) == 0
    assert commits.forget(spark, root, "vehicle_positions", -1) == 1


def test_a_batch_without_rows_is_done_at_once(spark, root):
    none = store.table_rows(two_days(spark).limit(0), "vehicle_position", NOW, "e")
    assert [store.append_once(none, root, "vehicle_positions", "e") for _ in range(2)] == [0, 0]
    assert vehicles(spark, root) == []
