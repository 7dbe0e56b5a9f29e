"""Property: a full load equals a first load plus daily incremental runs plus
revalidation of late parents, table by table (audit columns aside)."""

import datetime as dt

import pytest

from huddle import adapter
from huddle.config import JobConfig
from huddle.plans import batch
from huddle.session import scratch_path
from huddle.streaming.incremental import revalidate_clean
from tests.conftest import SF001

TS = dt.datetime(2024, 3, 1)
TABLES = [("clean", "clean_teams"), ("clean", "clean_membership"), ("clean", "clean_events"),
          ("clean", "clean_events_rsvps"), ("analytics", "d_teams"), ("analytics", "d_membership"),
          ("analytics", "d_events"), ("analytics", "f_events_rsvps"), ("analytics", "f_events_enriched")]


@pytest.fixture(scope="module")
def warehouses(spark):
    src = {e: adapter.raw(spark, SF001, e, p_date=False) for e in ("teams", "memberships", "events", "event_rsvps")}
    geo = adapter.geo_boxes(spark, SF001)
    full = batch.run_batch(spark, JobConfig(start_date="2024-01-01", end_date="2024-02-15", run_ts=TS), src, geo,
                           root=scratch_path(spark, "t-full"))
    root = scratch_path(spark, "t-inc")
    batch.run_batch(spark, JobConfig(start_date="2024-01-01", end_date="2024-02-13", run_ts=TS), src, geo, root=root)
    for d in ("2024-02-14", "2024-02-15"):
        batch.run_batch(spark, JobConfig.for_day(d, run_ts=TS), src, geo, root=root)
    batch.run_batch(spark, JobConfig.for_day("2024-02-15", run_ts=TS), src, geo, root=root)  # a rerun is harmless
    inc = batch.Warehouse(spark, JobConfig.for_day("2024-02-15", run_ts=TS), root)
    revalidate_clean(inc)
    return full, inc


@pytest.mark.parametrize("layer,name", TABLES)
def test_same_table(warehouses, layer, name):
    full, inc = warehouses
    a = full.read(layer, name).drop("etl_created_date", "etl_updated_date")
    b = inc.read(layer, name).drop("etl_created_date", "etl_updated_date").select(*a.columns)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_partition_emptied_when_its_only_row_moves(spark):
    """A key answered again on a later day leaves its old day empty."""
    import datetime as dt2
    from huddle import schemas
    D = dt2.datetime
    teams = spark.createDataFrame([("t1", "x", "NOR", D(2024, 1, 1))], schemas.TEAMS)
    members = spark.createDataFrame([("m1", "t1", "member", D(2024, 1, 1))], schemas.MEMBERSHIPS)
    events = spark.createDataFrame([("e1", "t1", D(2024, 1, 5), D(2024, 1, 5, 1), 1.0, 1.0, D(2024, 1, 1))],
                                   schemas.EVENTS)
    day1 = spark.createDataFrame([("r1", "e1", "m1", 1, D(2024, 1, 2))], schemas.EVENT_RSVPS)
    both = day1.unionByName(spark.createDataFrame([("r1", "e1", "m1", 2, D(2024, 1, 3))], schemas.EVENT_RSVPS))
    root = scratch_path(spark, "t-move")
    first = JobConfig(start_date="2024-01-01", end_date="2024-01-02")
    batch.run_batch(spark, first, {"teams": teams, "memberships": members, "events": events, "event_rsvps": day1},
                    root=root)
    batch.run_batch(spark, JobConfig.for_day("2024-01-03"),
                    {"teams": teams, "memberships": members, "events": events, "event_rsvps": both}, root=root)
    rows = spark.read.parquet(f"{root}/huddle_clean/clean_events_rsvps").collect()
    assert [(r.event_rsvp_id, r.rsvp_status, str(r.p_date), r.is_latest_response) for r in rows] == \
        [("r1", 2, "2024-01-03", True)]
    f = spark.read.parquet(f"{root}/huddle_analytics/f_events_rsvps").collect()
    assert [(r.event_rsvp_id, str(r.p_date)) for r in f] == [("r1", "2024-01-03")]


# ---- moved and changed data: base load + daily runs (+ revalidation) = one full load -------------------
D = dt.datetime


def _frames(spark, teams, members, events, rsvps):
    from huddle import schemas
    return {"teams": spark.createDataFrame(teams, schemas.TEAMS), "memberships": spark.createDataFrame(members, schemas.MEMBERSHIPS),
            "events": spark.createDataFrame(events, schemas.EVENTS), "event_rsvps": spark.createDataFrame(rsvps, schemas.EVENT_RSVPS)}


def _boxes(spark, rows):
    from huddle import schemas
    return spark.createDataFrame(rows, schemas.GEO_BOXES)


def _same(spark, full, inc, tables=TABLES):
    for layer, name in tables:
        a = full.read(layer, name).drop("etl_created_date", "etl_updated_date")
        b = inc.read(layer, name).drop("etl_created_date", "etl_updated_date").select(*a.columns)
        assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr), name


BASE = dict(
    teams=[("t1", "x", "NOR", D(2024, 1, 1)), ("t2", "y", "GBR", D(2024, 1, 1))],
    members=[("m1", "t1", "member", D(2024, 1, 1)), ("m2", "t2", "member", D(2024, 1, 2))],
    events=[("e1", "t1", D(2024, 1, 5), D(2024, 1, 5, 1), 60.0, 10.0, D(2024, 1, 1)),
            ("e2", "t1", D(2024, 1, 6), D(2024, 1, 6, 1), 60.0, 10.0, D(2024, 1, 2))],
    rsvps=[("r1", "e1", "m1", 1, D(2024, 1, 2)), ("r2", "e2", "m2", 0, D(2024, 1, 2)), ("r9", "e1", "m2", 0, None)])
BOXES = [("NOR", "Oslo", 59.0, 9.0, 61.0, 11.0), ("GBR", "Kent", 59.0, 9.0, 61.0, 11.0)]
# day 3 delivers: an event that moves, one whose old row survives, a team in another country, a membership
# of another team, an answer that moves; in the second case the boxes change too
DAY_3 = dict(
    events=[("e1", "t1", D(2024, 1, 1, 12), D(2024, 1, 1, 13), 60.0, 10.0, D(2024, 1, 3)),
            ("e2", "t1", D(2024, 1, 20), D(2024, 1, 20, 1), 60.0, 10.0, D(2024, 1, 3))],
    teams=[("t1", "a", "GBR", D(2024, 1, 3))], members=[("m2", "t1", "lead", D(2024, 1, 3))],
    rsvps=[("r1", "e2", "m1", 2, D(2024, 1, 3))])


@pytest.mark.parametrize("undated,boxes", [(False, BOXES), (True, [("GBR", "Devon", 59.0, 9.0, 61.0, 11.0)])])
def test_daily_run_equals_full_load(spark, undated, boxes):
    all_rows = {k: v + DAY_3.get(k, []) for k, v in BASE.items()}
    cfg = JobConfig(start_date="2024-01-01", end_date="2024-01-03", run_ts=TS, include_undated=undated)
    full = batch.run_batch(spark, cfg, _frames(spark, **all_rows), _boxes(spark, boxes), root=scratch_path(spark, "t-f"))
    root = scratch_path(spark, "t-i")
    batch.run_batch(spark, cfg.with_(end_date="2024-01-02"), _frames(spark, **BASE), _boxes(spark, BOXES), root=root)
    day = JobConfig.for_day("2024-01-03", run_ts=TS, include_undated=undated)
    inc = batch.run_batch(spark, day, _frames(spark, **all_rows), _boxes(spark, boxes), root=root)
    _same(spark, full, inc)
    assert inc.read("analytics", "f_events_enriched").where("event_id = 'e1'").count() == 1


def test_revalidation_recomputes_flags_among_valid_answers(spark):
    """r1 was rejected (its event came late), so r0 was the latest; then r1 turns valid and wins."""
    rows = {**BASE, "events": BASE["events"][:1], "rsvps": [("r0", "e1", "m1", 0, D(2024, 1, 1)), ("r1", "e1", "m1", 1, D(2024, 1, 2))],
            "members": [("m1", "t3", "member", D(2024, 1, 1))]}
    late = {**rows, "teams": rows["teams"] + [("t3", "z", "DEU", D(2024, 1, 3))]}
    cfg = JobConfig(start_date="2024-01-01", end_date="2024-01-03", run_ts=TS, latest_among="valid")
    full = batch.run_batch(spark, cfg, _frames(spark, **late), _boxes(spark, BOXES), root=scratch_path(spark, "t-f"))
    root = scratch_path(spark, "t-i")
    batch.run_batch(spark, cfg.with_(end_date="2024-01-02"), _frames(spark, **rows), _boxes(spark, BOXES), root=root)
    inc = batch.run_batch(spark, JobConfig.for_day("2024-01-03", run_ts=TS, latest_among="valid"), _frames(spark, **late),
                          _boxes(spark, BOXES), root=root)
    revalidate_clean(inc)
    _same(spark, full, inc)


def test_first_load_with_empty_layers(spark):
    rows = {**BASE, "teams": [("t1", "x", "NOR", D(2023, 1, 1))], "rsvps": []}
    wh = batch.run_batch(spark, JobConfig(start_date="2024-01-01", end_date="2024-01-03"), _frames(spark, **rows),
                         _boxes(spark, BOXES), root=scratch_path(spark, "t-e"))
    assert wh.read("clean", "clean_teams").count() == 0 and wh.read("analytics", "f_events_rsvps").count() == 0
    assert spark.table("v_f_events_rsvps").count() == 0


def test_quality_gate_fails_a_run(spark):
    wh = batch.run_batch(spark, JobConfig(start_date="2024-01-01", end_date="2024-01-03"), _frames(spark, **BASE),
                         _boxes(spark, BOXES), root=scratch_path(spark, "t-q"))
    wh.read("analytics", "d_teams").drop("etl_created_date").createOrReplaceTempView("v_d_teams")
    with pytest.raises(AssertionError):
        batch.check_published(wh)


def test_aggregates_are_written(spark):
    wh = batch.run_batch(spark, JobConfig(start_date="2024-01-01", end_date="2024-01-03"), _frames(spark, **BASE),
                         _boxes(spark, BOXES), root=scratch_path(spark, "t-a"))
    for name in ("membership_enriched", "weekly_monthly", "daily_active_teams", "new_vs_returning", "events_per_region", "dim_date"):
        assert wh.read("aggregates", name).count() > 0, name


def test_chain_is_a_registered_query():
    from huddle import inventory, oracle
    assert "inc_chain" in inventory.queries()
    assert oracle.oracle_sql()["inc_chain"] == oracle.oracle_sql()["fct_events_enriched"]
