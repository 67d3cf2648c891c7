"""The plans: no cross joins, no Python in the data path, filters and columns at the scan."""

import pytest

from registry import AS_OF, QUERIES, Tables
from tramline.plans import analytics

ACTIONS = ("stream_", "store_")
BATCH = sorted(q for q in QUERIES if not q.startswith(ACTIONS))
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow", "Cross")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not [word for word in FORBIDDEN if word in text]


@pytest.mark.parametrize("name", sorted(analytics.REPORTS))
def test_time_filter_reaches_the_scan(spark, sf_dir, name):
    text = plan(analytics.report(name, Tables(spark, sf_dir), as_of=AS_OF))
    assert "GreaterThanOrEqual(ts,2024-01-3" in text


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(QUERIES["q_delays"](spark, sf_dir))
    assert "ReadSchema: struct<ts:timestamp,event_type:string,value:double>" in text
    assert "LessThan(ts,2024-01-31 01:00:00" in text


def test_facts_are_aggregated_before_they_meet_a_dimension(spark, sf_dir):
    for name in ("q_performance", "q_stops", "q_routes", "q_geographic"):
        text = plan(QUERIES[name](spark, sf_dir))
        join = text.index("Join")
        assert "partial_count" in text[join:], name


def test_headway_windows_run_on_ticks(spark, sf_dir):
    text = plan(QUERIES["q_headways"](spark, sf_dir))
    lowest = text[text.rindex("Window ["):]
    assert "partial_count(1)" in lowest and "slot" in lowest


def test_documents_read_each_table_once(spark, sf_dir):
    """Views of one file are told apart by their columns; the anomalies' histogram is the one second reading."""
    scans = lambda df: [line for line in plan(df).splitlines() if "FileScan parquet" in line]
    t = Tables(spark, sf_dir)
    views = {name: len(scans(t(name))) for name in ("predictions", "vehicle_positions", "routes", "alerts")}
    assert len(scans(QUERIES["latest_stats"](spark, sf_dir))) <= sum(views.values())
    text = scans(QUERIES["stored_service_health"](spark, sf_dir))
    assert len(text) == views["predictions"] + views["alerts"]
