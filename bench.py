"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query after a warm-up round over all (default 3); the median counts
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry import QUERIES  # noqa: E402
from tramline.session import build_session  # noqa: E402

HEADLINE = [
    *[q for q in QUERIES if q.startswith("q_")],
    "route_summary", "service_health", "summary_stats", "service_summary", "window_performance",
    "upsert_predictions", "validate_prediction", "enrich_prediction", "link_predictions",
    "flatten_rest_predictions", "trip_delay_from_stops", "topic_routing",
    "stream_hourly_delays", "stream_sliding_kpis", "stream_headways",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    def timed(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    for name in names:
        timed(name)
    times = {name: round(statistics.median(timed(name) for _ in range(runs)), 4) for name in names}
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 4), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
