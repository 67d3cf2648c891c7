"""Progress of running streams: totals, failures and stalls per source."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tramline.functions.measures import row_count

#: Silence after which a feed counts as stalled, and how late rows of the log may be.
STALL, LOG_DELAY = "15 minutes", "5 minutes"


def feed_stalls(log: DataFrame, stall: str = STALL, delay: str = LOG_DELAY) -> DataFrame:
    """``source_type, state, since, runs, records``: when feeds came alive and when they stalled, from a stream of log rows.

    ``log`` has ``source_type, status, records_processed, completed_at``. Only
    runs that brought records are signs of life. A spell of life is a session
    that a silence of ``stall`` ends; it gives a row ``active`` at its start and
    a row ``stalled`` at the moment the silence had lasted that long. The rows
    of all feeds move the clock, so a feed that says nothing more is found out
    by the others, a beat of the clock among them. Runs of a busy feed are
    merged before the shuffle.
    """
    log.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    # The condition names the time, so it is not moved ahead of the watermark: rows without records move the clock as well.
    alive = log.withWatermark("completed_at", delay).where(
        F.when((F.col("status") != "error") & (F.col("records_processed") > 0), F.col("completed_at")).isNotNull())
    spells = alive.groupBy(F.session_window("completed_at", stall).alias("s"), "source_type").agg(
        row_count().alias("runs"), F.sum("records_processed").alias("records"))
    state = lambda name, since: F.struct(F.lit(name).alias("state"), F.col(since).alias("since"))
    return spells.select("source_type", F.explode(F.array(state("active", "s.start"), state("stalled", "s.end"))).alias("x"),
                         "runs", "records").select("source_type", "x.state", "x.since", "runs", "records")


# Fixed value: this many failures in a row mark a stream as degraded.
DEGRADED_FROM = 5


class IngestMonitor(StreamingQueryListener):
    """Keeps small counters per query; one instance watches a whole session."""

    def __init__(self, stall_seconds: float = 900):
        self.stall_seconds = stall_seconds
        self.names: dict[str, str] = {}
        self.state: dict[str, dict] = {}

    def _of(self, name: str) -> dict:
        return self.state.setdefault(name, {
            "records": 0, "batches": 0, "errors": 0, "consecutive_failures": 0, "last_data": None})

    def onQueryStarted(self, event) -> None:
        self.names[str(event.id)] = event.name or str(event.id)
        self._of(self.names[str(event.id)])

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        of = self._of(progress.name or self.names.get(str(progress.id), str(progress.id)))
        of["batches"] += 1
        of["records"] += progress.numInputRows
        of["consecutive_failures"] = 0
        if progress.numInputRows:
            of["last_data"] = time.time()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            of = self._of(self.names.get(str(event.id), str(event.id)))
            of["errors"] += 1
            of["consecutive_failures"] += 1

    def report(self, now: float | None = None) -> list[dict]:
        now = time.time() if now is None else now
        out = []
        for name, of in sorted(self.state.items()):
            silent = None if of["last_data"] is None else now - of["last_data"]
            out.append({
                "name": name, **{k: of[k] for k in ("records", "batches", "errors", "consecutive_failures")},
                "last_data": of["last_data"] and dt.datetime.fromtimestamp(of["last_data"], dt.timezone.utc),
                "stalled": silent is None or silent > self.stall_seconds,
                "status": "healthy" if of["consecutive_failures"] < DEGRADED_FROM else "degraded"})
        return out
