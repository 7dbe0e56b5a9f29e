"""Literal-row cases for the validation, dedupe and flag rules."""

import datetime as dt

from pyspark.sql import functions as F

from huddle import schemas
from huddle.config import JobConfig
from huddle.plans import clean, facts

CFG = JobConfig(start_date="2024-01-01", end_date="2024-01-31")
D = dt.datetime


def teams(spark, rows):
    df = spark.createDataFrame(rows, schemas.TEAMS)
    return df.withColumn("p_date", F.to_date("created_at"))


def members(spark, rows):
    return spark.createDataFrame(rows, schemas.MEMBERSHIPS).withColumn("p_date", F.to_date("joined_at"))


def events(spark, rows):
    return spark.createDataFrame(rows, schemas.EVENTS).withColumn("p_date", F.to_date("created_at"))


def rsvps(spark, rows):
    return spark.createDataFrame(rows, schemas.EVENT_RSVPS).withColumn("p_date", F.to_date("responded_at"))


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_team_country_rules(spark):
    t = clean.clean_teams(teams(spark, [
        ("t1", "football", "NOR", D(2024, 1, 2)),
        ("t2", "chess", None, D(2024, 1, 2)),        # NULL country -> undetermined
        ("t3", "golf", "SWE", D(2024, 1, 2)),        # outside the set
        (None, "x", "NOR", D(2024, 1, 2)),           # NULL key dropped
        ("t4", "golf", "NOR", D(2023, 12, 1)),       # outside the window
    ]), CFG)
    r = by_key(t, "team_id")
    assert set(r) == {"t1", "t2", "t3"}
    assert r["t1"]["is_valid_record"] is True and r["t1"]["validation_error"] is None
    assert r["t2"]["is_valid_record"] is None and r["t2"]["validation_error"] is None
    assert r["t3"]["is_valid_record"] is False and r["t3"]["validation_error"] == "Invalid country_code"
    assert r["t1"]["team_activity"] == "football"


def test_duplicate_key_survivor_is_repeatable(spark):
    t = clean.clean_teams(teams(spark, [
        ("t1", "b", "NOR", D(2024, 1, 2)),
        ("t1", "a", "GBR", D(2024, 1, 3)),
        ("t1", None, "USA", D(2024, 1, 4)),
    ]), CFG)
    rows = t.collect()
    assert len(rows) == 1 and rows[0]["team_activity"] == "a"  # ascending, NULLs last


def test_event_rules(spark):
    tm = clean.clean_teams(teams(spark, [("t1", "x", "NOR", D(2024, 1, 1))]), CFG)
    ev = clean.clean_events(events(spark, [
        ("e1", "t1", D(2024, 1, 5, 10), D(2024, 1, 5, 10), 60.0, 10.0, D(2024, 1, 2)),    # start = end valid
        ("e2", "t1", D(2024, 1, 5, 11), D(2024, 1, 5, 10), 60.0, None, D(2024, 1, 2)),    # start > end
        ("e3", "zz", D(2024, 1, 5, 10), None, None, None, D(2024, 1, 2)),                 # bad team, NULL end
        ("e4", "t1", D(2024, 1, 5, 10), None, 1.0, 2.0, D(2024, 1, 2)),                  # good team, NULL end
        ("e5", "t1", D(2024, 1, 5, 10, 0, 0, 900000), D(2024, 1, 5, 10, 0, 30, 100000), 1.0, 2.0, D(2024, 1, 2)),
    ]), tm, CFG)
    r = by_key(ev, "event_id")
    assert r["e1"]["is_valid_record"] is True and r["e1"]["event_duration_minutes"] == 0.0
    assert r["e2"]["is_valid_record"] is False and r["e2"]["validation_error"] == "Invalid Timestamps"
    assert r["e2"]["has_location"] is False and r["e2"]["event_duration_minutes"] == -60.0
    assert r["e3"]["is_valid_record"] is False and r["e3"]["validation_error"] == "Invalid FK team_id"
    assert r["e4"]["is_valid_record"] is None and r["e4"]["validation_error"] is None
    # sub-second parts are floored on each side: 10:00:00.9 -> 10:00:30.1 is 30 s
    assert r["e5"]["event_duration_minutes"] == 0.5


def _rsvp_world(spark, rows):
    tm = clean.clean_teams(teams(spark, [("t1", "x", "NOR", D(2024, 1, 1))]), CFG)
    mb = clean.clean_membership(members(spark, [("m1", "t1", "member", D(2024, 1, 1)),
                                                ("m2", "t9", "member", D(2024, 1, 1))]), tm, CFG)
    ev = clean.clean_events(events(spark, [("e1", "t1", D(2024, 1, 5), D(2024, 1, 5, 1), 1.0, 1.0,
                                            D(2024, 1, 2))]), tm, CFG)
    return clean.clean_event_rsvps(rsvps(spark, rows), mb, ev, CFG)


def test_rsvp_rules(spark):
    r = by_key(_rsvp_world(spark, [
        ("r1", "e1", "m1", 1, D(2024, 1, 3)),
        ("r2", "e1", "m1", 2, D(2024, 1, 4)),        # newer answer -> latest
        ("r3", "e1", "m2", 0, D(2024, 1, 4)),        # member with unknown team -> invalid FK
        ("r4", "e9", "m1", 3, D(2024, 1, 4)),        # orphan event, bad status
        ("r5", "e1", "m1", None, D(2024, 1, 2)),     # NULL status -> undetermined
        ("r6", "e1", "m1", 1, None),                 # undated -> dropped
        ("r7", "e9", "m9", None, D(2024, 1, 4)),     # NULL AND FALSE is FALSE
    ]), "event_rsvp_id")
    assert "r6" not in r
    assert r["r2"]["is_latest_response"] is True and r["r1"]["is_latest_response"] is False
    assert r["r2"]["rsvp_response"] == "declined" and r["r4"]["rsvp_response"] == "n/a"
    assert r["r5"]["rsvp_response"] == "n/a"
    assert r["r3"]["validation_error"] == "Invalid FK membership_id"
    assert r["r4"]["validation_error"] == "Invalid FK event_id, Invalid rsvp status"
    assert r["r5"]["is_valid_record"] is None and r["r5"]["validation_error"] is None
    assert r["r7"]["is_valid_record"] is False
    assert r["r7"]["validation_error"] == "Invalid FK event_id, Invalid FK membership_id"


def test_latest_ties_and_invalid_newest(spark):
    r = by_key(_rsvp_world(spark, [
        ("b", "e1", "m1", 1, D(2024, 1, 3)),
        ("a", "e1", "m1", 2, D(2024, 1, 3)),         # same time: lowest id wins
        ("c", "e1", "m1", 7, D(2024, 1, 2)),
    ]), "event_rsvp_id")
    assert r["a"]["is_latest_response"] and not r["b"]["is_latest_response"]
    # the newest answer wins even when invalid (source behaviour)
    r2 = by_key(_rsvp_world(spark, [("x", "e1", "m1", 1, D(2024, 1, 3)), ("y", "e1", "m1", 9, D(2024, 1, 4))]),
                "event_rsvp_id")
    assert r2["y"]["is_latest_response"] and not r2["y"]["is_valid_record"]
    cfg = CFG.with_(latest_among="valid")
    tm = clean.clean_teams(teams(spark, [("t1", "x", "NOR", D(2024, 1, 1))]), cfg)
    mb = clean.clean_membership(members(spark, [("m1", "t1", "member", D(2024, 1, 1))]), tm, cfg)
    ev = clean.clean_events(events(spark, [("e1", "t1", D(2024, 1, 5), D(2024, 1, 5, 1), 1.0, 1.0,
                                            D(2024, 1, 2))]), tm, cfg)
    r3 = by_key(clean.clean_event_rsvps(rsvps(spark, [("x", "e1", "m1", 1, D(2024, 1, 3)),
                                                      ("y", "e1", "m1", 9, D(2024, 1, 4))]), mb, ev, cfg),
                "event_rsvp_id")
    assert r3["x"]["is_latest_response"] and not r3["y"]["is_latest_response"]


def test_rsvp_duplicate_key_newest_survives(spark):
    r = _rsvp_world(spark, [
        ("k", "e1", "m1", 1, D(2024, 1, 3)),
        ("k", "e1", "m1", 2, D(2024, 1, 9)),
        ("k", "e1", "m1", 0, None),
    ]).collect()
    assert len(r) == 1 and r[0]["rsvp_status"] == 2


def test_enriched_event_without_rsvps_and_regions(spark):
    tm = clean.clean_teams(teams(spark, [("t1", "x", "NOR", D(2024, 1, 1))]), CFG)
    ev = clean.clean_events(events(spark, [
        ("edge", "t1", D(2024, 1, 5), D(2024, 1, 5, 1), 60.0, 10.0, D(2024, 1, 2)),   # on a box edge
        ("two", "t1", D(2024, 1, 5), D(2024, 1, 5, 1), 61.0, 11.0, D(2024, 1, 2)),    # in two boxes
        ("none", "t1", D(2024, 1, 5), D(2024, 1, 5, 1), 10.0, 10.0, D(2024, 1, 2)),   # in no box
        ("noloc", "t1", D(2024, 1, 5), D(2024, 1, 5, 1), 61.0, None, D(2024, 1, 2)),  # one coordinate
    ]), tm, CFG)
    geo = spark.createDataFrame([("NOR", "Zeta", 60.0, 10.0, 62.0, 12.0), ("NOR", "Alpha", 60.5, 10.5, 63.0, 13.0),
                                 ("GBR", "Aaa", 0.0, 0.0, 90.0, 90.0)], schemas.GEO_BOXES)
    f = spark.createDataFrame([], "event_rsvp_id string, event_id string, membership_id string, rsvp_status int, "
                                  "responded_at timestamp, is_latest_response boolean, p_date date")
    from huddle.plans import dims
    e = by_key(facts.fct_events_enriched(dims.dim_events(ev, CFG, False), dims.dim_teams(tm, CFG, False), geo, f,
                                         CFG, audit=False), "event_id")
    assert e["edge"]["region"] == "Zeta"
    assert e["two"]["region"] == "Alpha"
    assert e["none"]["region"] is None and e["noloc"]["region"] is None
    assert e["edge"]["total_rsvps"] is None and float(e["edge"]["event_attendance_rate"]) == 0.0
    cfg = CFG.with_(region_tie="smallest_area")
    e2 = by_key(facts.fct_events_enriched(dims.dim_events(ev, cfg, False), dims.dim_teams(tm, cfg, False), geo, f,
                                          cfg, audit=False), "event_id")
    assert e2["two"]["region"] == "Zeta"


def _grid_case(spark):
    """Points with repeated and NULL ids, and boxes of very different sizes (one spans the globe)."""
    pts = [(str(i % 7) if i % 5 else None, "NOR" if i % 4 else "GBR", 55.0 + i * 0.37, 4.0 + i * 0.53, bool(i % 6))
           for i in range(60)] + [("x", None, 56.0, 5.0, True), ("y", "NOR", None, 5.0, True), ("z", "NOR", 55.0, 4.0, True)]
    boxes = [("NOR", f"S{j}", 55.0 + j, 4.0 + j, 58.5 + j, 9.0 + j) for j in range(8)] + [
        ("NOR", None, 60.0, 10.0, 61.0, 11.0), ("GBR", "World", -90.0, -180.0, 90.0, 180.0), (None, "N", 0.0, 0.0, 90.0, 90.0)]
    return (pts, boxes, spark.createDataFrame(pts, "id string, country_code string, latitude double, longitude double, "
                                                   "has_location boolean"), spark.createDataFrame(boxes, schemas.GEO_BOXES))


def _hits(p, boxes):
    return [b for b in boxes if p[4] and p[1] is not None and p[1] == b[0] and p[2] is not None
            and b[2] <= p[2] <= b[4] and b[3] <= p[3] <= b[5]]


def test_region_keeps_every_row_and_matches_brute_force(spark):
    from huddle.operators import geo as G
    pts, boxes, pdf, bdf = _grid_case(spark)

    def first(p):
        return min((b[1] for b in _hits(p, boxes)), key=lambda s: (s is not None, s or ""), default=None)

    got = sorted((tuple(r) for r in G.with_region(pdf, bdf).collect()), key=repr)
    assert got == sorted(((*p, first(p)) for p in pts), key=repr)


def test_box_matches_equals_brute_force(spark):
    from huddle.operators import geo as G
    pts, boxes, pdf, bdf = _grid_case(spark)
    got = sorted((tuple(r) for r in G.box_matches(pdf, bdf).select("id", "latitude", "state").collect()), key=repr)
    want = [(p[0], p[2], b[1] if b else None) for p in pts for b in (_hits(p, boxes) or [None])]
    assert got == sorted(want, key=repr)


def test_week_bucket_keeps_year(spark):
    from huddle.functions import exprs as X
    df = spark.createDataFrame([(D(2023, 1, 4), D(2024, 1, 3))], "a timestamp, b timestamp")
    r = df.select(F.weekofyear("a").alias("wa"), F.weekofyear("b").alias("wb"),
                  X.week_start("a").alias("sa"), X.week_start("b").alias("sb")).first()
    assert r["wa"] == r["wb"] and r["sa"] != r["sb"]
