"""As-of join and intervals against plain loops."""

import random

from huddle.operators.asof import as_of_join, intervals


def _data(spark):
    rng = random.Random(3)
    right = [(rng.choice(["a", "b", "c"]), rng.choice([None, *range(12)]), rng.choice([None, 0, 1]), i) for i in range(60)]
    left = [(rng.choice(["a", "b", "z"]), rng.choice([None, *range(-1, 13)]), i) for i in range(60)] + [("a", 5, 7)] * 2
    return left, right, spark.createDataFrame(left, "k string, t int, n int"), spark.createDataFrame(right, "k string, at int, v int, id int")


def test_as_of_join(spark):
    left, right, l, r = _data(spark)
    want = []
    for k, t, n in left:
        seen = [x for x in right if x[0] == k and x[1] is not None and t is not None and x[1] <= t]
        best = min(seen, key=lambda x: (-x[1], x[3]), default=None)
        want.append((k, t, n, best[2] if best else None, best[3] if best else None))  # a null value in force is a value
    got = [tuple(x) for x in as_of_join(l, r, ["k"], "t", "at", ["v", "id"], ["id"]).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert as_of_join(l, r.limit(0), ["k"], "t", "at", ["v"], ["id"]).where("v IS NULL").count() == len(left)
    assert as_of_join(l.limit(0), r, ["k"], "t", "at", ["v"], ["id"]).count() == 0


def test_intervals(spark):
    _, right, _, r = _data(spark)
    want = []
    for k in "abc":
        at = sorted({x[1] for x in right if x[0] == k and x[1] is not None})
        for t, nxt in zip(at, [*at[1:], None]):
            want.append((k, min((x for x in right if x[:2] == (k, t)), key=lambda x: x[3])[2], t, nxt))
    assert sorted(map(tuple, intervals(r, ["k"], "at", ["v"], ["id"]).collect()), key=repr) == sorted(want, key=repr)


def test_activity_streaks(spark):
    """Weeks in a row, a gap, several answers in one week, a run over the turn of the year, an answer without a time."""
    import datetime as dt
    from huddle.plans.metrics import activity_streaks
    D = dt.datetime
    rows = [("m1", D(2024, 12, 17)), ("m1", D(2024, 12, 23)), ("m1", D(2024, 12, 29)), ("m1", D(2024, 12, 30)), ("m1", D(2025, 1, 6)),
            ("m1", D(2025, 2, 3)), ("m2", D(2025, 2, 9)), ("m2", None), ("m3", None)]
    got = sorted(map(tuple, activity_streaks(spark.createDataFrame(rows, "membership_id string, responded_at timestamp")).collect()))
    assert got == [("m1", dt.date(2024, 12, 16), 4, None), ("m1", dt.date(2025, 2, 3), 1, 3), ("m2", dt.date(2025, 2, 3), 1, None)]
