"""The bucketed list of key locations."""

import datetime as dt

from pyspark.sql import functions as F

from huddle.config import JobConfig
from huddle.operators.locations import Locations, composite, find_or_scan
from huddle.plans.batch import Warehouse
from huddle.session import scratch_path

DAY = dt.date(2024, 1, 1)


def _rows(spark, n, day):
    return spark.range(n).select(F.concat(F.lit("k"), F.col("id")).alias("id"), F.date_add(F.lit(DAY), day).alias("p_date"))


def _days(df):
    return sorted((r[0] is None, (r[0] - DAY).days if r[0] else 0) for r in df.collect())


def test_find_add_rebuild(spark):
    wh = Warehouse(spark, JobConfig(), scratch_path(spark, "t-loc"))
    loc = Locations(wh, "t", "id", buckets=4)
    keys = spark.createDataFrame([("k3",), ("k90",), ("zz",), (None,)], "id string")
    assert not loc.exists() and find_or_scan(loc, None, keys) is None
    loc.rebuild(_rows(spark, 10, F.col("id").cast("int")).unionByName(spark.createDataFrame([("k4", None)], "id string, p_date date")))
    assert loc.exists() and _days(loc.find(keys)) == [(False, 3)]
    loc.add(_rows(spark, 100, F.lit(20)), None)
    assert _days(loc.find(keys)) == [(False, 3), (False, 20)]  # an old location stays: too much, never too little
    assert _days(loc.find(keys.where("id = 'k90'"))) == [(False, 20)]
    assert _days(loc.find(spark.createDataFrame([("k4",)], "id string"))) == [(False, 4), (False, 20), (True, 0)]
    again = Locations(Warehouse(spark, JobConfig(), wh.root), "t", "id", buckets=4)  # another run finds the same list
    assert _days(again.find(keys)) == [(False, 3), (False, 20)]
    loc.rebuild(_rows(spark, 5, F.lit(1)))
    assert _days(loc.find(keys)) == [(False, 1)]
    near = find_or_scan(loc, None, keys)
    assert _rows(spark, 5, F.col("id").cast("int")).where(near).count() == 1
    assert loc.find(keys.where("id = 'zz'")).count() == 0


def test_a_first_list_is_complete(spark):
    """A table that has no list yet: the first addition also records what is stored, so nothing is missed later."""
    wh = Warehouse(spark, JobConfig(), scratch_path(spark, "t-loc"))
    loc = Locations(wh, "t", "id", buckets=4)
    loc.add(_rows(spark, 2, F.lit(5)), _rows(spark, 10, F.lit(1)))
    assert _days(loc.find(spark.createDataFrame([("k7",)], "id string"))) == [(False, 1)]
    assert _days(loc.find(spark.createDataFrame([("k1",)], "id string"))) == [(False, 1), (False, 5)]


def test_stored_side_is_not_shuffled(spark):
    """Only the day's keys move, whether or not they fit a broadcast, and only the list is read."""
    wh = Warehouse(spark, JobConfig(), scratch_path(spark, "t-loc"))
    loc = Locations(wh, "t", "id", buckets=8)
    loc.rebuild(_rows(spark, 1000, F.lit(0)))
    keys = _rows(spark, 300, F.lit(0)).select("id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in ("-1", before):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            found = loc.find(keys)
            assert found.count() == 1
            plan = found._jdf.queryExecution().executedPlan().toString()
            below = plan[plan.index("Join"):]
            scan = below[:below.index("FileScan")].split("\n")
            # between the join and the scan of the list there is no exchange on its own (left) branch
            left = [x for x in scan if x.lstrip().startswith((":", "+-", "*")) and "Exchange" in x and "Range" not in x]
            assert "Bucketed: true" in below or limit != "-1", plan
            assert not [x for x in left if x.lstrip().startswith(":") and "hashpartitioning" in x], plan
            assert "ReadSchema: struct<key:string,p_date:date>" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_composite_keys_do_not_collide(spark):
    rows = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("a", None), ("1:a", "b"), ("1", ":ab"), (None, None), ("~", None)]
    df = spark.createDataFrame(rows, "x string, y string").select(composite("x", "y").alias("k"))
    assert df.distinct().count() == len(rows)
    assert df.where("k IS NULL").count() == 0
