"""Quality reports: every raw row lands in exactly one outcome; undated and
cast-loss counts."""

from pyspark.sql import functions as F

from huddle import adapter, schemas
from huddle.config import JobConfig
from huddle.inventory import Chain
from huddle.plans import quality
from huddle.sources.catalog import in_window
from tests.conftest import SF001

CFG = JobConfig(start_date="2024-01-01", end_date="2024-02-15")


def test_row_accounting_adds_up(spark):
    c = Chain(spark, SF001, CFG)
    raw = c.raw("event_rsvps")
    rep = {r["outcome"]: r["n"] for r in
           quality.row_accounting(raw, c.clean_rsvps, "event_rsvp_id", in_window(CFG)).collect()}
    assert sum(rep.values()) == raw.count()
    assert rep["valid"] == 38 and rep["invalid"] == 3328
    assert rep["undated"] == quality.undated(raw, "raw").first()["value"] > 0
    assert rep["duplicate_dropped"] > 0


def test_cast_loss_report(spark):
    raw = adapter.raw(spark, SF001, "event_rsvps", p_date=False)
    strings = raw.select(*[F.col(n).cast("string").alias(n) for n in raw.columns]).withColumn(
        "rsvp_status", F.when(F.col("rsvp_status") == "3", "three").otherwise(F.col("rsvp_status")))
    rep = {r["column_name"]: r["lost"] for r in quality.cast_loss_report(strings, schemas.EVENT_RSVPS,
                                                                           "event_rsvps").collect()}
    assert rep["rsvp_status"] == raw.where("rsvp_status = 3").count() > 0
    assert rep["responded_at"] == 0
