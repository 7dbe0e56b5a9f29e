"""The source pipeline's own view checks, run on the published tables of a full
run: queryable, expected columns, keys and dates not NULL, accepted values."""

import pytest
from pyspark.sql import functions as F

from huddle import adapter
from huddle.config import JobConfig
from huddle.plans import batch, facts, quality
from huddle.session import scratch_path
from tests.conftest import SF001

CFG = JobConfig(start_date="2024-01-01", end_date="2024-02-15")
WIDE = ["event_rsvp_id", "event_id", "membership_id", "rsvp_status", "responded_at", "event_start", "event_end",
        "event_duration_minutes", "team_id", "country_code", "role_title", "etl_created_date", "p_date"]


@pytest.fixture(scope="module")
def wh(spark):
    src = {e: adapter.raw(spark, SF001, e, p_date=False) for e in ("teams", "memberships", "events", "event_rsvps")}
    return batch.run_batch(spark, CFG, src, adapter.geo_boxes(spark, SF001), root=scratch_path(spark, "t-views"))


def test_raw_counts_match_source(spark, wh):
    for entity, table in (("teams", "raw_teams"), ("event_rsvps", "raw_events_rsvps")):
        r = quality.count_parity(adapter.raw(spark, SF001, entity), wh.read("raw", table), entity).first()
        assert r["ok"], r


def test_dim_teams_view(spark, wh):
    v = spark.table("v_d_teams")
    assert v.limit(1).count() >= 0
    assert {"team_id", "team_activity", "country_code", "created_at", "etl_created_date",
            "etl_updated_date"} <= set(v.columns)
    assert v.where(F.col("team_id").isNull()).count() == 0
    assert v.count() == 72


def test_fact_views(spark, wh):
    f = spark.table("v_f_events_rsvps")
    assert f.where("event_rsvp_id IS NULL").count() == 0
    assert f.where("rsvp_status NOT IN (0, 1, 2)").count() == 0
    assert f.where("etl_created_date IS NULL").count() == 0
    assert set(WIDE) <= set(f.columns)  # the published view itself is the wide one
    wide = facts.fct_event_rsvps_wide(wh.read("analytics", "f_events_rsvps"), spark.table("v_d_events"),
                                      spark.table("v_d_teams"), spark.table("v_d_membership"))
    assert wide.select(*WIDE).exceptAll(f.select(*WIDE)).count() == 0 and wide.count() == f.count()
    assert f.where("event_start IS NULL OR event_end IS NULL").count() == 0
    e = spark.table("v_f_events_enriched")
    assert e.count() == spark.table("v_d_events").count() == 251
    assert e.agg(F.sum("total_rsvps")).first()[0] == 29
