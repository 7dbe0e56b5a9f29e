"""All levels of a rollup in one aggregation."""

from huddle.plans.metrics import activity_rollup

ROWS = [("NOR", "Oslo", "run", "t1", 3), ("NOR", "Oslo", "run", "t1", None), ("NOR", "Oslo", "ski", "t2", 1), ("NOR", None, "run", "t3", 2),
        ("GBR", None, "run", "t4", None), (None, None, None, None, 5)]


def test_levels(spark):
    df = spark.createDataFrame(ROWS, "country_code string, region string, team_activity string, team_id string, total_rsvps bigint")
    rollup = activity_rollup(df)
    want = set()
    for level, keep in ((0, 3), (1, 2), (3, 1), (7, 0)):
        groups = {}
        for r in ROWS:
            groups.setdefault(r[:keep] + (None,) * (3 - keep), []).append(r)
        for k, g in groups.items():
            want.add((*k, level, len(g), len({r[3] for r in g} - {None}), sum(r[4] or 0 for r in g)))
    got = [tuple(r) for r in rollup.collect()]
    assert set(got) == want and len(got) == len(want)
    # the logical plan: an adaptive physical plan prints its first and its final form once it has run
    assert rollup._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_empty(spark):
    df = spark.createDataFrame([], "country_code string, region string, team_activity string, team_id string, total_rsvps bigint")
    assert [tuple(r) for r in activity_rollup(df).where("events > 0").collect()] == []
