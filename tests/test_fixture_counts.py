"""The chain's counts against the regression table of FIXTURES.md."""

import pytest
from pyspark.sql import functions as F

from huddle.inventory import RANGE_CFG, Chain

# (rows, valid, invalid, undetermined) per clean table, and RSVP / enriched figures
EXPECTED = {
    "/root/testdata/sf0.001": {
        "teams": (112, 72, 18, 22), "membership": (1500, 685, None, None), "events": (1000, 251, 747, 2),
        "rsvps": (3366, 38, 3328, 0), "bad": (3242, 1843, 74), "latest": (29, 888),
        "enriched": (251, 29, 76, 12, 29, 8),
    },
    "/root/testdata/sf0.01": {
        "teams": (1150, 795, 175, 180), "membership": (15000, 7752, None, None), "events": (10000, 4592, 5359, 49),
        "rsvps": (32909, 7439, 25356, 114), "bad": (17875, 16055, 692), "latest": (5516, 8533),
        "enriched": (4592, 3454, 1346, 25, 5516, 2153),
    },
}


def buckets(df):
    r = df.agg(F.count(F.lit(1)), F.count_if(F.col("is_valid_record")), F.count_if(~F.col("is_valid_record")),
               F.count_if(F.col("is_valid_record").isNull())).first()
    return tuple(r)


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_fixture_counts(spark, sf):
    exp, c = EXPECTED[sf], Chain(spark, sf, RANGE_CFG)
    assert buckets(c.clean_teams) == exp["teams"]
    m = buckets(c.clean_membership)
    assert m[:2] == exp["membership"][:2]
    assert buckets(c.clean_events) == exp["events"]
    assert buckets(c.clean_rsvps) == exp["rsvps"]
    r = c.clean_rsvps.agg(F.count_if(~F.col("is_valid_event_id")), F.count_if(~F.col("is_valid_membership_id")),
                          F.count_if(~F.col("is_valid_rsvp")),
                          F.count_if(F.col("is_valid_record") & F.col("is_latest_response")),
                          F.count_if(~F.col("is_latest_response"))).first()
    assert tuple(r[:3]) == exp["bad"] and tuple(r[3:]) == exp["latest"]
    e = c.enriched.agg(F.count(F.lit(1)), F.count("total_rsvps"), F.count("region"), F.countDistinct("region"),
                       F.sum("total_rsvps"), F.sum("accepted_rsvps")).first()
    assert tuple(e) == exp["enriched"]


@pytest.mark.parametrize("sf,rsvps,enriched", [
    ("/root/testdata/sf0.001", (4074, 208, 3866, 0), (544, 145, 156, 24, 145, 53)),
    ("/root/testdata/sf0.01", (40512, 15780, 24506, 226), (6139, 5504, 1818, 25, 10960, 4322))])
def test_all_dated_rows(spark, sf, rsvps, enriched):
    c = Chain(spark, sf)
    assert buckets(c.clean_rsvps) == rsvps
    e = c.enriched.agg(F.count(F.lit(1)), F.count("total_rsvps"), F.count("region"), F.countDistinct("region"),
                       F.sum("total_rsvps"), F.sum("accepted_rsvps")).first()
    assert tuple(e) == enriched
