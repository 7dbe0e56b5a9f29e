"""The same run on catalog tables: databases, partitioned tables, views, and a
daily run that replaces only its partitions (insertInto, dynamic mode)."""

from huddle import adapter
from huddle.config import JobConfig
from huddle.plans import batch
from tests.conftest import SF001


def test_catalog_tables_and_daily_run(spark):
    src = {e: adapter.raw(spark, SF001, e, p_date=False) for e in ("teams", "memberships", "events", "event_rsvps")}
    cfg = JobConfig(start_date="2024-01-01", end_date="2024-02-14", raw_db="t_raw", clean_db="t_clean",
                    analytics_db="t_analytics")
    batch.run_batch(spark, cfg, src, adapter.geo_boxes(spark, SF001))
    before = spark.table("t_clean.clean_events_rsvps").count()
    day = JobConfig.for_day("2024-02-15", raw_db="t_raw", clean_db="t_clean", analytics_db="t_analytics")
    batch.run_batch(spark, day, src, adapter.geo_boxes(spark, SF001))
    assert spark.table("t_clean.clean_events_rsvps").count() >= before
    assert spark.table("t_analytics.v_f_events_enriched").count() == spark.table("t_analytics.d_events").count()
    parts = {r[0] for r in spark.sql("SHOW PARTITIONS t_raw.raw_teams").collect()}
    assert any("2024-02-15" in p for p in parts) and any("2024-01-02" in p for p in parts)


def test_retention_on_path_and_catalog_tables(spark):
    from huddle.plans.maintenance import run_retention
    from huddle.session import scratch_path
    src = {"event_rsvps": adapter.raw(spark, SF001, "event_rsvps", p_date=False)}
    for root, db in ((scratch_path(spark, "t-ret"), "r_raw"), (None, "r2_raw")):
        wh = batch.Warehouse(spark, JobConfig(raw_db=db, clean_db="r_clean", analytics_db="r_an"), root)
        batch.load_raw(wh, src)
        before = wh.read("raw", "raw_events_rsvps")
        n_all, n_old = before.count(), before.where("p_date < DATE '2024-01-15'").count()
        rep = run_retention(wh, "raw", "raw_events_rsvps", "2024-01-15")
        dropped = sum(r["rows"] for r in rep.collect() if r["action"] == "drop")
        after = wh.read("raw", "raw_events_rsvps")
        assert dropped == n_old > 0
        assert after.count() == n_all - n_old
        assert after.where("p_date IS NULL").count() > 0
