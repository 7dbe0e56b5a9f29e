"""Schema cast/gate, CSV reading, and the sinks (overwrite modes, upsert, views)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from huddle import schemas
from huddle.operators import schema as S, sinks
from huddle.session import scratch_path
from huddle.sources import files, jdbc

D = dt.datetime


def test_cast_keeps_extra_columns_and_counts_losses(spark):
    raw = spark.createDataFrame([("1", "e", "m", "2", "2024-01-01 10:00:00", "x"),
                                 ("2", "e", "m", "two", "not a time", "y")],
                                "EVENT_RSVP_ID string, event_id string, membership_id string, rsvp_status string, "
                                "responded_at string, extra string")
    cast = S.cast_to_schema(raw, schemas.EVENT_RSVPS)
    assert cast.columns[:5] == [f.name for f in schemas.EVENT_RSVPS.fields] and "extra" in cast.columns
    rows = cast.orderBy("event_rsvp_id").collect()
    assert rows[0]["rsvp_status"] == 2 and rows[1]["rsvp_status"] is None and rows[1]["responded_at"] is None
    loss = S.cast_losses(raw, schemas.EVENT_RSVPS).first()
    assert loss["rsvp_status"] == 1 and loss["responded_at"] == 1 and loss["event_id"] == 0


def test_gate_reports_extra_missing_reordered(spark):
    base = S.cast_to_schema(spark.createDataFrame([("t", "a", "NOR", "2024-01-01 00:00:00")],
                                                  "team_id string, group_activity string, country_code string, "
                                                  "created_at string"), schemas.TEAMS)
    S.gate(base, schemas.TEAMS)
    with pytest.raises(S.SchemaMismatch, match="extra: x"):
        S.gate(base.withColumn("x", F.lit(1)), schemas.TEAMS)
    with pytest.raises(S.SchemaMismatch, match="reordered"):
        S.gate(base.select(*reversed(base.columns)), schemas.TEAMS)
    with pytest.raises(S.SchemaMismatch, match="missing: created_at"):
        S.gate(base.drop("created_at"), schemas.TEAMS)
    with pytest.raises(ValueError, match="missing declared"):
        S.cast_to_schema(base.drop("created_at"), schemas.TEAMS)


def test_csv_header_case_and_geo_rename(spark):
    p = scratch_path(spark, "t-csv")
    spark.createDataFrame([("T1", "golf", "NOR", "2024-01-02T03:04:05")],
                          "TEAM_ID string, GROUP_ACTIVITY string, COUNTRY_CODE string, CREATED_AT string") \
        .write.option("header", True).csv(p)
    df = files.read_entity_csv(spark, p, schemas.TEAMS)
    assert df.columns == ["team_id", "group_activity", "country_code", "created_at"]
    assert df.first()["created_at"] == D(2024, 1, 2, 3, 4, 5)
    assert files.count_csv_rows(spark, p).first()["rows"] == 1
    g = scratch_path(spark, "t-geo")
    spark.createDataFrame([("NOR", "Oslo", "59.8", "10.5", "60.1", "10.9")],
                          "countryCode string, state string, min_lat string, min_lng string, max_lat string, "
                          "max_lng string").write.option("header", True).csv(g)
    geo = files.read_geo_csv(spark, g)
    assert geo.schema == schemas.GEO_BOXES and geo.first()["min_lat"] == 59.8


def test_jdbc_query_text():
    sql = jdbc.select_sql("src.events_rsvps", schemas.EVENT_RSVPS, "responded_at", "2024-01-01", "2024-01-31")
    assert sql.startswith("SELECT event_rsvp_id, event_id, membership_id, rsvp_status, responded_at FROM")
    assert "responded_at >= '2024-01-01' AND responded_at < '2024-02-01'" in sql
    assert "WHERE" not in jdbc.select_sql("t", schemas.TEAMS)


def _days(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, p_date date")


def test_static_and_dynamic_partition_overwrite(spark):
    p = scratch_path(spark, "t-part")
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    sinks.write_partitioned(_days(spark, [("a", 1, d1), ("b", 1, d2)]), p)
    sinks.write_partitioned(_days(spark, [("b", 2, d2), ("c", 2, d3)]), p, dynamic=True)
    got = {(r.k, r.v) for r in spark.read.parquet(p).collect()}
    assert got == {("a", 1), ("b", 2), ("c", 2)}
    sinks.write_partitioned(_days(spark, [("z", 3, d3)]), p)  # full overwrite drops other dates
    assert {(r.k, r.v) for r in spark.read.parquet(p).collect()} == {("z", 3)}


def test_upsert_type1(spark):
    p = scratch_path(spark, "t-upsert")
    old, new = D(2024, 1, 1), D(2024, 2, 1)
    tgt = spark.createDataFrame([("1", "a", old, old), ("2", "b", old, old)],
                                "id string, v string, etl_created_date timestamp, etl_updated_date timestamp")
    sinks.write_full(tgt, p)
    src = spark.createDataFrame([("2", "B", new, new), ("3", "c", new, new)], tgt.schema)
    sinks.upsert(spark, src, p, "id")
    r = {x.id: x for x in spark.read.parquet(p).collect()}
    assert r["1"].v == "a" and r["1"].etl_updated_date == old                                    # untouched
    assert r["2"].v == "B" and r["2"].etl_created_date == old and r["2"].etl_updated_date == new  # changed
    assert r["3"].etl_created_date == new                                                          # new key
    sinks.upsert(spark, src, p, "id")                                                             # idempotent
    assert {x.id: x for x in spark.read.parquet(p).collect()} == r
    with pytest.raises(sinks.DuplicateSourceKeys):
        sinks.upsert(spark, src.unionByName(src), p, "id")


def test_view_over_path(spark):
    p = scratch_path(spark, "t-view")
    sinks.write_full(spark.range(3).withColumnRenamed("id", "x"), p)
    sinks.create_view(spark, "v_test_path", p)
    assert spark.table("v_test_path").count() == 3


def test_unreadable_target_is_never_replaced(spark):
    """Only a path that is not found counts as absent."""
    import os
    p = scratch_path(spark, "t-broken")
    rows = spark.range(1000).select(F.col("id").cast("string").alias("id"), F.lit("a").alias("v"),
                                    F.lit(D(2024, 1, 1)).alias("etl_created_date"))
    rows.coalesce(1).write.parquet(p)
    assert not sinks.target_exists(spark, p + "-absent") and sinks.target_exists(spark, p)
    name = next(n for n in os.listdir(p.removeprefix("file:")) if n.endswith(".parquet"))
    full = os.path.join(p.removeprefix("file:"), name)
    with open(full, "wb") as f:
        f.write(b"not parquet at all")
    with pytest.raises(Exception):
        sinks.upsert(spark, rows.limit(1), p, "id")
    with open(full, "rb") as f:
        assert f.read() == b"not parquet at all"  # untouched


def test_table_without_files_is_read_with_its_schema(spark):
    p = scratch_path(spark, "t-empty")
    sinks.write_partitioned(_days(spark, []), p, "p_date")
    assert sinks.read_target(spark, p, schema="k string, v int, p_date date").count() == 0


def test_drop_partitions_leaves_the_others(spark):
    import datetime as dt2
    p = scratch_path(spark, "t-drop")
    d1, d2 = dt2.date(2024, 1, 1), dt2.date(2024, 1, 2)
    sinks.write_partitioned(_days(spark, [("a", 1, d1), ("b", 1, d2), ("n", 1, None)]), p)
    sinks.drop_partitions(spark, p, "p_date", [d1, None])
    assert {(r.k, r.v) for r in spark.read.parquet(p).collect()} == {("b", 1)}


def test_merge_statement():
    sql = sinks.merge_sql("db.t", "src", ["id", "v", "etl_created_date"], "id", "etl_created_date")
    assert "ON t.id = s.id" in sql and "UPDATE SET t.id = s.id, t.v = s.v WHEN" in sql
    assert "INSERT (id, v, etl_created_date) VALUES (s.id, s.v, s.etl_created_date)" in sql


def test_jdbc_reads_are_always_split():
    opts = jdbc.split_options("created_at", "2024-01-01", "2024-01-08", None, None, None, None)
    assert opts == {"partitionColumn": "created_at", "lowerBound": "2024-01-01", "upperBound": "2024-01-09", "numPartitions": "8"}
    assert jdbc.split_options(None, None, None, "id", 0, 10, 4)["upperBound"] == "10"
    for args in ((None, None, None, None, None, None, None), (None, None, None, "id", None, 5, None)):
        with pytest.raises(ValueError):
            jdbc.split_options(*args)


def test_broken_swap_is_put_right(spark):
    """A job that dies between the two renames leaves the previous version; the next look restores it."""
    import os
    p = scratch_path(spark, "t-swap")
    spark.range(3).write.parquet(p)
    os.rename(p.removeprefix("file:"), p.removeprefix("file:") + "__previous")
    assert sinks.target_exists(spark, p)
    assert spark.read.parquet(p).count() == 3


def _encodings(path):
    """Encodings of each column in the files below a path."""
    import glob

    import pyarrow.parquet as pq
    out = {}
    for f in glob.glob(f"{path.removeprefix('file://')}/**/*.parquet", recursive=True):
        group = pq.ParquetFile(f).metadata.row_group(0)
        for i in range(group.num_columns):
            out.setdefault(group.column(i).path_in_schema, set()).update(group.column(i).encodings)
    return out


def test_keys_are_written_without_dictionaries(spark):
    from huddle.config import JobConfig
    from huddle.operators.locations import Locations
    from huddle.plans.batch import Warehouse
    # keys that recur would be worth a dictionary to the writer: others it gives up on its own, after building it
    rows = spark.range(2000).selectExpr("concat('k', id % 20) AS event_rsvp_id", "cast(id % 3 as string) AS role_title",
                                        "date_add(date'2024-01-01', cast(id div 20 as int)) AS p_date")
    wh = Warehouse(spark, JobConfig(), scratch_path(spark, "t-plain"))
    wh.write(rows, "raw", "t")
    Locations(wh, "t", "event_rsvp_id", buckets=2).rebuild(rows)
    stored, listed = _encodings(wh.target("raw", "t")), _encodings(wh.target("clean", "locations_t_event_rsvp_id_2"))
    assert not any("DICTIONARY" in e for e in stored["event_rsvp_id"] | listed["key"])
    assert any("DICTIONARY" in e for e in stored["role_title"]) and any("DICTIONARY" in e for e in listed["p_date"])
    assert wh.read("raw", "t").exceptAll(rows).count() == 0 and wh.read("raw", "t").count() == 2000
