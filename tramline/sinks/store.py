"""Writing typed records to the stored tables.

A batch can be written twice after a failure, also one that stopped half-way.
Keyed tables take only absent keys, so a repeat adds what is missing; the other
tables take a batch under a plan of its files (``commits``), which is finished
or found done. Folders are by day, however many batches a day has;
``compact_day`` puts the files of a finished day together.
"""

from __future__ import annotations

import datetime as dt
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tramline.functions.clock import AsOf, as_of_column
from tramline.functions.measures import row_count
from tramline.operators import referential
from tramline.operators.flatten import table_rows
from tramline.operators.upsert import KEYS, new_rows
from tramline.schemas import PARTITION_COLUMNS, TABLES
from tramline.session import settle
from tramline.sinks import commits
from tramline.sources.tables import create_tables, read_days, read_table, seeded, table_path

TABLE_OF = {
    "stop": "stops", "route": "routes", "trip": "trips", "prediction": "predictions",
    "vehicle_position": "vehicle_positions", "trip_update": "trip_updates", "alert": "alerts",
}
# Columns that rows are sorted by inside a file, so that its statistics are narrow.
SORT_COLUMNS = {
    "predictions": ["route_id", "timestamp"],
    "vehicle_positions": ["route_id", "timestamp"],
    "trip_updates": ["route_id", "timestamp"],
}


def shaped(df: DataFrame, table: str) -> DataFrame:
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in TABLES[table]])


def write_rows(df: DataFrame, root: str, table: str, mode: str) -> None:
    """Write rows to their folders; rebalancing gives a small day one file and splits a hot one."""
    write_files(df, table_path(root, table), table, mode)


def write_files(df: DataFrame, path: str, table: str, mode: str) -> None:
    """Write rows of a table below any folder, as ``write_rows``."""
    rows, folders = shaped(df, table), PARTITION_COLUMNS.get(table, [])
    if folders:
        rows = rows.hint("rebalance", *folders)
    if table in SORT_COLUMNS:
        rows = rows.sortWithinPartitions(*folders, *SORT_COLUMNS[table])
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if folders:
        writer = writer.partitionBy(*folders)
    writer.parquet(path)


def rows_written(seen: Observation) -> int:
    """The observed row count. A plan found empty at run time is cut and observes nothing."""
    try:
        return int(seen.get["rows"])
    except Py4JJavaError:
        return 0


def insert_absent(rows: DataFrame, root: str, table: str, *order: str) -> int:
    """Insert-if-absent into a keyed table; returns how many rows were added."""
    spark = rows.sparkSession
    # The keys of predictions hold the arrival time, so only the arrival days of the batch can hold its keys.
    target = read_days(spark, root, table, "arrival_date", rows) if table == "predictions" else read_table(spark, root, table)
    fresh = new_rows(rows, target, KEYS[table], *order)
    if table in PARTITION_COLUMNS:
        added = Observation()
        write_rows(fresh.observe(added, row_count().alias("rows")), root, table, "append")
        return rows_written(added)
    # A dimension rarely gains rows, and writing none would still leave a file.
    fresh = fresh.persist()
    try:
        n = fresh.count()
        if n:
            write_rows(fresh, root, table, "append")
        return n
    finally:
        fresh.unpersist()


def append_once(rows: DataFrame, root: str, table: str, batch_id: str) -> int:
    """Appends a batch that the table does not have yet; returns how many rows this call wrote."""
    added = Observation()
    watched = rows.observe(added, row_count().alias("rows"))
    fresh = commits.append(watched, root, table, batch_id, lambda df, path: write_files(df, path, table, "append"))
    return rows_written(added) if fresh else 0


def compact_day(spark, root: str, table: str, day: str) -> None:
    """The files of one day of a table put together into as few as its size asks for.

    For days that no stream writes to any more: the rows are written to the
    shared folder first and then take the place of the day's files.
    """
    commits.finish(spark, root, table)
    column = PARTITION_COLUMNS[table][0]
    rows = read_table(spark, root, table).where(F.col(column) == day)
    write_rows(settle(rows, f"compact-{table}"), root, table, "overwrite")


def repair_references(records: DataFrame, kind: str, root: str, seed_missing: bool = True) -> dict[str, int]:
    """Add placeholder dimension rows for the keys that a batch of facts uses."""
    spark = records.sparkSession
    dim = lambda name: read_table(spark, root, name)
    added = {}
    if "route_id" in records.columns and kind != "route":
        added["routes"] = insert_absent(
            shaped(referential.missing_routes(dim("routes"), records), "routes"), root, "routes", "route_name")
    if kind == "prediction":
        added["stops"] = insert_absent(
            shaped(referential.missing_stops(dim("stops"), records), "stops"), root, "stops", "stop_name")
    if "trip_id" in records.columns and kind != "trip":
        trips = referential.missing_trips(dim("trips"), records)
        added["trips"] = insert_absent(shaped(trips, "trips"), root, "trips", "route_id")
        if added["trips"]:
            insert_absent(shaped(referential.unknown_route(dim("routes")), "routes"), root, "routes", "route_name")
    if kind in ("prediction", "vehicle_position") and seed_missing:
        added["vehicles"] = insert_absent(
            shaped(referential.missing_vehicles(dim("vehicles"), records), "vehicles"),
            root, "vehicles", "vehicle_id")
    return added


def store(
    records: DataFrame, kind: str, root: str, batch_id: str = "0", as_of: AsOf = None,
    seed_missing: bool = True, source: str | None = None, failed: int = 0,
) -> dict:
    """Store typed records of one type and log the outcome; errors are logged and returned.

    The records are read several times, so the caller holds them in memory or in
    a table (``session.settle``). ``failed`` is how many were refused before.
    """
    if kind not in TABLE_OF:
        raise ValueError(f"unknown record type {kind!r}")
    table, began = TABLE_OF[kind], time.monotonic()
    outcome = {
        "source_type": source or kind, "processed": 0, "inserted": 0, "failed": failed,
        "status": "success", "error": None}
    try:
        outcome["processed"] = records.count()
        if kind in ("prediction", "vehicle_position", "trip_update"):
            repair_references(records, kind, root, seed_missing)
        if kind == "trip":
            insert_absent(
                shaped(referential.missing_routes(read_table(records.sparkSession, root, "routes"), records),
                       "routes"), root, "routes", "route_name")
        rows = table_rows(records, kind, as_of, batch_id, source)
        if table in KEYS:
            # The first write of a key wins: the first to arrive, or the smallest row where no order is known.
            values = [c for c in rows.columns if c not in KEYS[table] and not c.startswith("affected")]
            order = ["position"] if "position" in rows.columns else values
            outcome["inserted"] = insert_absent(rows, root, table, *order)
        else:
            outcome["inserted"] = append_once(rows, root, table, batch_id)
    except Exception as fault:  # noqa: BLE001 - the outcome row carries the error to the log
        outcome |= {"status": "error", "error": str(fault)}
    outcome["milliseconds"] = int((time.monotonic() - began) * 1000)
    log_ingestion(records, root, outcome, f"{batch_id}-{kind}", as_of)
    return outcome


def store_all(
    frames: dict[str, DataFrame], root: str, batch_id: str = "0", as_of: AsOf = None,
    seed_missing: bool = True, failed: dict[str, int] | None = None,
) -> dict:
    """Store one frame per record type, dimensions first; success, partial or error over all."""
    order = [k for k in TABLE_OF if k in frames]
    refused = failed or {}
    outcomes = {
        k: store(frames[k], k, root, batch_id, as_of, seed_missing, failed=refused.get(k, 0)) for k in order}
    good = [o["status"] == "success" for o in outcomes.values()]
    status = "success" if all(good) else "partial" if any(good) else "error"
    return {"status": status, "by_type": outcomes}


def log_ingestion(df: DataFrame, root: str, outcome: dict, batch_id: str, as_of: AsOf = None) -> None:
    """One row in the log of its day; a batch that has one with the same outcome gets no other."""
    spent = dt.timedelta(milliseconds=outcome.get("milliseconds", 0))
    done = as_of_column(as_of)
    row = df.sparkSession.range(1).select(
        F.lit(outcome["source_type"]).alias("source_type"),
        F.lit(outcome["status"]).alias("status"),
        F.lit(outcome["processed"]).alias("records_processed"),
        F.lit(outcome["inserted"]).alias("records_inserted"),
        F.lit(0).alias("records_updated"),
        F.lit(outcome["failed"]).alias("records_failed"),
        F.lit(outcome.get("milliseconds", 0)).alias("processing_time_ms"),
        F.lit(outcome.get("error")).alias("error_message"),
        (done - F.lit(spent)).alias("started_at"), done.alias("completed_at"),
        F.lit(batch_id).alias("batch_id"), F.date_format(done, "yyyy-MM-dd").alias("partition_date"))
    append_once(row, root, "data_ingestion_logs", f"{batch_id}-{outcome['status']}")


def initialise(spark, root: str) -> int:
    """Create missing tables, finish batches that stopped half-way, and put the seed routes into an empty store."""
    create_tables(spark, root)
    for table in ("vehicle_positions", "trip_updates", "quarantine", "data_ingestion_logs", "delay_summary"):
        commits.finish(spark, root, table)
    return insert_absent(shaped(seeded(read_table(spark, root, "routes")), "routes"), root, "routes", "route_name")
