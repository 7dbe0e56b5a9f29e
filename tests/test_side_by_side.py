"""Steps of a run side by side, and looks at stored tables that need no job."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F

from huddle.config import JobConfig
from huddle.operators.locations import Locations
from huddle.plans import batch
from huddle.session import scratch_path, together
from huddle.streaming import incremental as I, retraction as R


def _jobs(spark, step):
    """How many Spark jobs a step runs."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        step()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def _warehouse(spark):
    return batch.Warehouse(spark, JobConfig(full_load=False), scratch_path(spark, "t-side"))


def test_steps_overlap_and_keep_their_order(spark):
    meet = threading.Barrier(2, timeout=60)  # breaks unless both steps are under way at once
    assert together(spark, lambda: (meet.wait(), "a")[1], lambda: (meet.wait(), "b")[1]) == ["a", "b"]
    assert together(spark) == []


def test_every_step_has_local_properties_of_its_own(spark):
    spark.sparkContext.setLocalProperty("t.side", "outer")
    meet = threading.Barrier(2, timeout=60)

    def step(name):
        seen = spark.sparkContext.getLocalProperty("t.side")
        spark.sparkContext.setLocalProperty("t.side", name)
        meet.wait()
        return seen, spark.sparkContext.getLocalProperty("t.side")
    assert together(spark, lambda: step("a"), lambda: step("b")) == [("outer", "a"), ("outer", "b")]
    assert spark.sparkContext.getLocalProperty("t.side") == "outer"
    spark.sparkContext.setLocalProperty("t.side", None)


def test_all_steps_have_ended_when_an_error_is_raised(spark):
    done = []

    def fails():
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError, match="lost"):
        together(spark, fails, lambda: done.append(spark.range(10).count()))
    assert done == [10]


def test_memberships_and_events_stop_when_the_teams_fail(spark, monkeypatch):
    wh = batch.Warehouse(spark, JobConfig(), scratch_path(spark, "t-side"))
    frames = {"teams": "group_activity string, country_code string, created_at timestamp"}
    monkeypatch.setattr(batch, "_raw", lambda wh, e: spark.createDataFrame([], "team_id string, membership_id string, event_id string, "
                                                                           "group_id string, role_title string, joined_at timestamp, p_date date, "
                                                                           + frames["teams"]))

    def fails(df, cfg):
        raise RuntimeError("no teams")
    monkeypatch.setattr(batch.clean, "validate_teams", fails)
    with pytest.raises(RuntimeError, match="no teams"):
        batch.run_clean(wh)
    assert not wh.exists("clean", "clean_membership") and not wh.exists("clean", "clean_events")


def test_looks_at_stored_tables_run_no_job(spark):
    wh = _warehouse(spark)
    staged = I._stage(wh, spark.range(3), "t")
    assert _jobs(spark, lambda: wh.exists("raw", "nothing")) == 0
    wh.write(staged.select("id", F.lit("2024-01-01").cast("date").alias("p_date")), "raw", "t", "p_date")
    assert _jobs(spark, lambda: (wh.exists("raw", "t"), wh.read("raw", "t"))) == 0
    assert wh.read("raw", "t").dtypes == [("id", "bigint"), ("p_date", "date")] and wh.read("raw", "t").count() == 3
    plain = _jobs(spark, lambda: spark.range(3).write.parquet(scratch_path(spark, "t")))
    assert _jobs(spark, lambda: I._stage(wh, spark.range(3), "t")) == plain


def test_a_change_set_is_looked_up_once_and_again_after_it_was_written(spark):
    wh = _warehouse(spark)
    assert R.noted(wh, "clean_teams") is None
    R.note(wh, "clean_teams", spark.createDataFrame([("t1", None)], "key string, p_date date"))
    assert R.noted(wh, "clean_teams").count() == 1
    assert _jobs(spark, lambda: R.noted(wh, "clean_teams")) == 0
    R.settle(wh)
    assert all(R.noted(w, "clean_teams") is None for w in (wh, batch.Warehouse(spark, wh.cfg, wh.root)))


def test_locations_are_moved_once(spark):
    wh = _warehouse(spark)
    rows = spark.range(100).select((F.col("id") % 10).cast("string").alias("id"), F.lit("2024-01-01").cast("date").alias("p_date"))
    places = Locations(wh, "t", "id", buckets=4).places(rows)
    assert places._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert places.count() == 10
