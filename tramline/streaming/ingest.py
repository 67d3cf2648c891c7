"""Continuous ingest: decode, flatten, validate, store; bad input goes to quarantine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tramline.functions.clock import AsOf, as_of_column
from tramline.operators import flatten
from tramline.operators.shape import stack
from tramline.operators.validate import REASONS, rejected, valid, validate
from tramline.schemas import DOCUMENTS
from tramline.session import settle
from tramline.sinks.publish import as_json
from tramline.sinks.store import append_once, store_all
from tramline.sources import feeds


class IngestError(RuntimeError):
    """A batch of which some part was not stored; its outcomes are in ``outcome``."""

    def __init__(self, outcome: dict):
        self.outcome = outcome
        faults = {k: o["error"] for k, o in outcome["by_type"].items() if o["error"]}
        super().__init__(f"not stored: {faults}")


def typed_frames(decoded: DataFrame, form: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Typed records per type, and what could not be read as ``(kind, reasons, payload)``.

    The payload of what is refused is the line as it came; of a feed message,
    which holds many entities, it is the entity.
    """
    docs = feeds.documents(decoded)
    reason = lambda text: F.array(F.lit(text) if isinstance(text, str) else text).alias(REASONS)
    bad = feeds.undecodable(decoded).select(
        F.lit("unknown").alias("kind"), reason("undecodable"), F.col("corrupt").alias("payload"))
    refuse = lambda df, why, payload="raw": df.select(F.lit("unknown").alias("kind"), reason(why), F.col(payload).alias("payload"))
    if form == "rest":
        known = flatten.rest_unreadable(docs)
        good = known.where("fault IS NULL").drop("fault")
        frames = {
            "prediction": flatten.rest_predictions(good), "vehicle_position": flatten.rest_vehicles(good)}
        refused = [refuse(flatten.rest_unknown(docs), "unknown_type"), refuse(known.where("fault IS NOT NULL"), F.col("fault"))]
    elif form == "feed":
        entities = flatten.feed_entities(docs).withColumn("wild", flatten.wild_entity())
        good = entities.where("NOT wild")
        frames = {
            "vehicle_position": flatten.feed_positions(good),
            "trip_update": flatten.feed_trip_updates(good), "alert": flatten.feed_alerts(good)}
        refused = [refuse(entities.where("wild").withColumn("payload", F.to_json("entity")), "wild_time", "payload")]
    else:
        named = flatten.record_type(docs).withColumn("wild", flatten.loose_wild(docs))
        good = named.where("NOT wild")
        frames = {k: flatten.typed_records(good, k) for k in flatten.RECORDS}
        refused = [refuse(flatten.untyped(good), "unknown_type"), refuse(named.where("wild"), "wild_time")]
    return {k: flatten.conform(df, k) for k, df in frames.items()}, stack(bad, *refused)


def process_batch(
    lines: DataFrame, batch_id: str, root: str, form: str = "rest", as_of: AsOf = None,
    seed_missing: bool = True, settled: bool = False, source: str | None = None,
) -> dict:
    """One batch from text lines to stored tables; a repeat of the batch changes nothing.

    Storing reads a frame several times, so text is decoded once and records are
    checked once: held in memory for a micro-batch, or ``settled`` in the shared
    folder for a bulk load. Raises IngestError, after logging, unless all was stored.
    """
    place = ["position"] if "position" in lines.columns else []
    lines = lines.withColumn("position", F.struct(*place, F.monotonically_increasing_id().alias("line")))
    hold = lambda df, label: settle(df, f"{batch_id}-{label}") if settled else df.persist()
    held = []
    try:
        held.append(hold(feeds.decode(lines, DOCUMENTS[form]), "decoded"))
        frames, bad = typed_frames(held[0], form)
        checked = {kind: hold(validate(df, kind, as_of), kind) for kind, df in frames.items()}
        held += checked.values()
        payload = lambda kind: as_json(*[c for c in frames[kind].columns if c not in flatten.CARRIED]) if form == "feed" else F.col("raw")
        refused = stack(bad, *[
            rejected(df).select(F.lit(kind).alias("kind"), REASONS, payload(kind).alias("payload"))
            for kind, df in checked.items()])
        day = F.date_format(as_of_column(as_of), "yyyy-MM-dd")
        append_once(refused.withColumns({"batch_id": F.lit(batch_id), "partition_date": day}), root, "quarantine", batch_id)
        failed = {k: rejected(df).count() for k, df in checked.items()}
        outcome = store_all(
            {k: valid(df) for k, df in checked.items()}, root, batch_id, as_of, seed_missing, failed)
    finally:
        for df in held:
            df.unpersist()
    if outcome["status"] != "success":
        raise IngestError(outcome)
    return outcome


def start_ingest(
    lines: DataFrame, root: str, checkpoint: str, name: str, form: str = "rest", as_of: AsOf = None,
    trigger: dict | None = None, seed_missing: bool = True, settled: bool = False,
) -> StreamingQuery:
    """Run ``process_batch`` on every micro-batch; the checkpoint holds the source offsets.

    A batch's id is the stream's ``name``, the id of the query, which its
    checkpoint keeps over restarts, and the number of the batch: streams into one
    store stay apart, also one that is begun anew. A batch that was not stored
    ends the query, and the next start takes it again.
    """
    def each(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        process_batch(batch, f"{name}-{query}-{number}", root, form, as_of, seed_missing, settled)

    return (
        lines.writeStream.queryName(name).foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "15 seconds"})).start())


def start_refresh(ticks: DataFrame, refresh, checkpoint: str, every: str = "30 seconds") -> StreamingQuery:
    """Call ``refresh(batch_id)`` on a schedule, to recompute and publish summaries."""
    return (
        ticks.writeStream.foreachBatch(lambda _, number: refresh(number))
        .option("checkpointLocation", checkpoint).trigger(processingTime=every).start())


def run_to_table(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append", partition_by: list[str] | None = None,
) -> None:
    """Run a stream over all that is there now, into a Parquet table."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        writer = writer.outputMode("append").format("parquet").option("path", path)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
    else:
        writer = writer.outputMode("complete").foreachBatch(
            lambda batch, _: batch.write.mode("overwrite").parquet(path))
    writer.start().awaitTermination()


def stream_to_frame(spark: SparkSession, stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """The result of a finished stream, read back from its table."""
    schema = stream.schema
    run_to_table(stream, f"{folder}/table", f"{folder}/checkpoint", mode)
    return spark.read.schema(schema).parquet(f"{folder}/table")


#: How far behind all rows a closing row lies: past every window, session and watermark.
AFTER_ALL = "interval 30 days"


def closing_rows(df: DataFrame, latest, time: str = "timestamp") -> DataFrame:
    """One row of ``df``'s columns with nothing but a time long after ``latest``.

    At the end of a source that has run dry it lets the watermark pass all that
    is still open. Its own window or session stays open, so no result holds it.
    """
    at = (F.lit(latest).cast("timestamp") + F.expr(AFTER_ALL)).alias(time)
    return df.sparkSession.range(1).select(*[at if f.name == time else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])


def run_in_parts(
    spark: SparkSession, sources: dict[str, DataFrame], make, folder: str, cuts: tuple = (), mode: str = "append",
    time: str = "timestamp",
) -> DataFrame:
    """The whole result of a stream over sources that arrive part by part and then run dry.

    Rows of every source before the first of ``cuts`` (times, ascending) land
    first, and so on; the stream takes each part as a batch, goes on from its
    checkpoint, and after the last part a row per source closes what is open.
    ``make`` turns streams, by name, into the stream that is run.
    """
    newest = [df.agg(F.max(time)).first()[0] for df in sources.values()]
    latest = max((x for x in newest if x is not None), default=dt.datetime(1970, 1, 2))
    place = {name: f"{folder}/{name}" for name in sources}
    stream = lambda: make({name: spark.readStream.schema(df.schema).parquet(place[name]) for name, df in sources.items()})
    at = F.col(time)
    edges = [None, *cuts, None]
    for low, high in zip(edges[:-1], edges[1:]):
        for name, df in sources.items():
            part = df if low is None else df.where((at >= F.lit(low)) | at.isNull())
            part = part if high is None else part.where(at < F.lit(high))
            part = part.unionByName(closing_rows(df, latest, time)) if high is None and mode == "append" else part
            part.write.mode("append").parquet(place[name])
        run_to_table(stream(), f"{folder}/table", f"{folder}/checkpoint", mode)
    return spark.read.schema(stream().schema).parquet(f"{folder}/table")
