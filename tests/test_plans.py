"""Plan shape: pruning and pushdown reach the scan, no Python in the plans,
group limits before each shuffle, equi-joins only."""

import pytest

from huddle import adapter
from huddle.config import JobConfig
from huddle.inventory import Chain
from huddle.plans import batch, clean
from huddle.session import scratch_path
from tests.conftest import SF001

CFG = JobConfig(start_date="2024-01-01", end_date="2024-02-15")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wh(spark):
    src = {e: adapter.raw(spark, SF001, e, p_date=False) for e in ("teams", "memberships", "events", "event_rsvps")}
    w = batch.Warehouse(spark, CFG, scratch_path(spark, "t-plans"))
    batch.load_raw(w, src, adapter.geo_boxes(spark, SF001))
    return w


def test_window_becomes_partition_filter(wh):
    df = clean.clean_teams(wh.read("raw", "raw_teams"), CFG)
    p = plan(df)
    assert "PartitionFilters: [isnotnull(p_date" in p and "2024-01-01" in p


def test_projection_pruned_at_scan(wh):
    df = wh.read("raw", "raw_events_rsvps").select("event_rsvp_id")
    assert "ReadSchema: struct<event_rsvp_id:string>" in plan(df)


def test_rsvp_clean_plan(spark, wh):
    """No Python; survivors are group limits on both sides of the shuffle; the rows
    are shuffled for the dedupe and the two foreign keys only."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(Chain(spark, SF001).clean_rsvps)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in p
    assert "WindowGroupLimit" in p and "Partial" in p and "SortAggregate" not in p


def test_dedupe_carries_each_column_once(spark, wh):
    p = plan(clean.clean_teams(wh.read("raw", "raw_teams"), CFG))
    assert p.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in p


def test_enriched_plan(spark):
    c = Chain(spark, SF001)
    p = plan(c.enriched)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p  # boxes meet points by cell
    assert "BatchEvalPython" not in p
