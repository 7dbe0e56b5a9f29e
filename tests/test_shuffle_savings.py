"""What a run neither moves nor stores twice."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from huddle.config import JobConfig
from huddle.operators.locations import Locations
from huddle.plans import batch, facts
from huddle.session import scratch_path


def _codecs(path):
    files = glob.glob(f"{path.removeprefix('file:')}/**/*.parquet", recursive=True)
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_rows}


def _joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join")


def test_wide_view_joins_only_what_a_query_reads(spark):
    spark.sql("SELECT * FROM VALUES ('r1', 'e1', 'm1'), ('r2', 'e9', NULL), ('r3', 'e2', 'm1') AS t(event_rsvp_id, event_id, membership_id)"
              ).createOrReplaceTempView("w_f")
    spark.sql("SELECT event_id, TIMESTAMP'2024-01-01 10:00:00' AS event_start, CAST(NULL AS TIMESTAMP) AS event_end, "
              "90 AS event_duration_minutes, team_id FROM VALUES ('e1', 't1'), ('e2', 't2') AS t(event_id, team_id)"
              ).createOrReplaceTempView("w_e")
    spark.sql("SELECT * FROM VALUES ('t1', 'NOR') AS t(team_id, country_code)").createOrReplaceTempView("w_t")
    spark.sql("SELECT * FROM VALUES ('m1', 'coach') AS t(membership_id, role_title)").createOrReplaceTempView("w_m")
    wide = spark.sql(facts.wide_view_sql("w_f", "w_e", "w_t", "w_m"))
    got = {(r.event_rsvp_id, r.event_duration_minutes, r.team_id, r.country_code, r.role_title) for r in wide.collect()}
    assert got == {("r1", 90, "t1", "NOR", "coach"), ("r2", None, None, None, None), ("r3", 90, "t2", None, "coach")}
    assert sorted(wide.columns) == sorted(["event_rsvp_id", "event_id", "membership_id", "event_start", "event_end",
                                           "event_duration_minutes", "team_id", "country_code", "role_title"])
    assert _joins(wide) == 3
    assert _joins(wide.agg(F.count(F.lit(1)))) == 0
    assert _joins(wide.agg(F.count_if(F.col("event_start").isNull()))) == 1


def test_stored_files_are_zstd(spark):
    wh = batch.Warehouse(spark, JobConfig(), scratch_path(spark, "t-codec"))
    rows = spark.range(10).select(F.col("id").cast("string").alias("id"), F.lit("2024-01-01").cast("date").alias("p_date"))
    wh.write(rows, "raw", "t", "p_date")
    places = Locations(wh, "t", "id", buckets=2)
    places.rebuild(rows)
    assert _codecs(wh.target("raw", "t")) == _codecs(places.path) == {"ZSTD"}


def test_scans_of_stored_files_are_not_taken_for_smaller_than_they_are(spark):
    from huddle.session import FILE_FACTOR, STORED_FACTOR, prepare
    assert float(prepare(spark).conf.get(FILE_FACTOR)) >= STORED_FACTOR > 1


def test_a_full_load_stores_raw_rows_without_a_shuffle_and_a_day_in_few_files(spark):
    import glob as g
    from huddle import schemas
    from tests.conftest import SF001
    from huddle import adapter
    src = {"events": adapter.raw(spark, SF001, "events", p_date=False).repartition(3)}
    seen = {}
    for full in (True, False):
        cfg = JobConfig(full_load=True) if full else JobConfig.for_day("2024-01-15")
        wh = batch.Warehouse(spark, cfg, scratch_path(spark, "t-raw"))
        batch.load_raw(wh, src)
        t = wh.target("raw", schemas.ENTITIES["events"][3]).removeprefix("file:")
        seen[full] = len(g.glob(f"{t}/p_date=2024-01-15/*.parquet"))
        assert wh.read("raw", schemas.ENTITIES["events"][3]).where("p_date = DATE '2024-01-15'").count() == \
            src["events"].where("to_date(created_at) = DATE '2024-01-15'").count()
    assert seen == {True: 3, False: 1}


def test_small_sides_of_joins_are_hashed_not_sorted(spark):
    from huddle.session import prepare
    limit, partitions = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions"
    before = {k: spark.conf.get(k) for k in (limit, partitions)}
    prepare(spark).conf.set(limit, "-1")
    try:
        keys = spark.range(0, 3000, 2).select(F.col("id").alias("k"))
        df = spark.range(3000).join(keys, F.col("id") == F.col("k"), "left")
        assert len(df.where("k IS NULL").collect()) == 1500
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "isFinalPlan=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
