"""Malformed CSV lines go to the quarantine, and every delivered line is accounted for."""

import os

import pytest

from huddle import schemas
from huddle.session import scratch_path
from huddle.sources import quarantine as Q

HEADER = "EVENT_RSVP_ID,event_id,membership_id,rsvp_status,responded_at,note"
GOOD = ["r1,e1,m1,1,2024-01-01 10:00:00,", "r2,e1,,,,", "r2,e1,,,,", 'r3,"e,1",m1,0,2024-01-02 10:00:00,"a ""b"""']
BAD = {"r4,e1,m1,two,2024-01-01 10:00:00,x": "value: rsvp_status", "r5,e1,m1,9999999999,tomorrow,": "value: rsvp_status, responded_at",
       "r6,e1,m1": "field count", "r7,e1,m1,1,2024-01-01 10:00:00,x,y": "field count", '"r8,e1': "field count"}


def _write(spark, *files):
    path = scratch_path(spark, "t-quarantine")
    os.makedirs(path)
    for i, lines in enumerate(files):
        with open(f"{path}/f{i}.csv", "w") as f:
            f.write("".join(x + "\n" for x in lines))
    return path


def _load(spark, path):
    table, bad = scratch_path(spark, "t-q-raw"), scratch_path(spark, "t-q-bad")
    Q.load_checked(spark, path, "event_rsvps", table, bad)
    return spark.read.parquet(table), spark.read.parquet(bad)


def test_every_line_is_in_one_table(spark):
    bad_lines = list(BAD)
    path = _write(spark, [HEADER, *GOOD, "", "   ", *bad_lines[:2]], [HEADER, *bad_lines[2:], GOOD[0]], [HEADER])
    good, bad = _load(spark, path)
    assert [f.name for f in schemas.EVENT_RSVPS.fields] + ["p_date"] == good.columns
    assert sorted(r.event_rsvp_id for r in good.collect()) == ["r1", "r1", "r2", "r2", "r3"]
    assert {r.event_id for r in good.collect()} == {"e1", "e,1"}
    assert good.where("event_rsvp_id = 'r2' AND rsvp_status IS NULL AND responded_at IS NULL AND p_date IS NULL").count() == 2
    got = {r.line: r.reason for r in bad.collect()}
    assert {k.rstrip(","): v for k, v in got.items()} == {k.rstrip(","): v for k, v in BAD.items()}
    row = Q.line_account(spark, path, good, bad, "event_rsvps").first()
    assert tuple(row) == ("event_rsvps", 10, 5, 5, True)
    lost = Q.line_account(spark, path, good.limit(4), bad, "event_rsvps").first()
    assert not lost.balanced


def test_no_bad_lines_and_no_lines(spark):
    good, bad = _load(spark, _write(spark, [HEADER, *GOOD]))
    assert (good.count(), bad.count(), bad.columns) == (4, 0, ["reason", "line"])
    path = _write(spark, [HEADER])
    checked = Q.read_checked(spark, path, schemas.EVENT_RSVPS)
    assert Q.good_rows(checked).count() == Q.quarantined(checked).count() == 0
    assert tuple(Q.line_account(spark, path, Q.good_rows(checked), Q.quarantined(checked), "e").first()) == ("e", 0, 0, 0, True)


def test_headers_must_agree(spark):
    with pytest.raises(ValueError, match="membership_id"):
        Q.read_checked(spark, _write(spark, ["event_rsvp_id,event_id,rsvp_status,responded_at"]), schemas.EVENT_RSVPS)
    other = ",".join(reversed(HEADER.split(",")))
    checked = Q.read_checked(spark, _write(spark, [HEADER, *GOOD], [other, GOOD[0]]), schemas.EVENT_RSVPS)
    with pytest.raises(Exception, match="(?i)header"):
        checked.collect()
