"""Benchmark: headline jobs of the pipeline over the adapter views at one scale.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
A warm-up run comes first; every figure is the median of three complete runs
(a written table, or a no-op sink that evaluates every row). The full load and
the one-day run both include their raw load.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from huddle import adapter  # noqa: E402
from huddle.config import JobConfig  # noqa: E402
from huddle.operators import sinks  # noqa: E402
from huddle.plans import clean, facts, metrics  # noqa: E402
from huddle.plans.batch import Warehouse, load_raw, run_batch  # noqa: E402
from huddle.session import build_session, scratch_path  # noqa: E402

WINDOW = JobConfig(start_date="2024-01-01", end_date="2024-02-15")


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


ERRORS: dict[str, str] = {}
RUNS = 3


def timed(fn, name: str = "") -> float | None:
    """Median seconds of three complete runs; a failure is reported, not fatal."""
    took = []
    for _ in range(RUNS):
        t = time.perf_counter()
        try:
            fn()
        except Exception as e:  # noqa: BLE001
            ERRORS[name or getattr(fn, "__name__", "?")] = str(e).splitlines()[0][:300]
            return None
        took.append(time.perf_counter() - t)
    return round(statistics.median(took), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="huddle-bench", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": "16g"})
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = m.group(1) if m else sf_dir

    root = scratch_path(spark, "bench-wh")
    cfg = WINDOW
    wh = Warehouse(spark, cfg, root)
    sources = {e: adapter.raw(spark, sf_dir, e, p_date=False)
               for e in ("teams", "memberships", "events", "event_rsvps")}
    load_raw(wh, sources, adapter.geo_boxes(spark, sf_dir))
    drain(clean.clean_teams(wh.read("raw", "raw_teams"), cfg))  # warm-up

    q: dict[str, float] = {}
    q["full_load"] = timed(name="full_load", fn=lambda: run_batch(spark, cfg, sources, root=root))
    q["cln_event_rsvps"] = timed(name="cln_event_rsvps", fn=lambda: drain(clean.clean_event_rsvps(
        wh.read("raw", "raw_events_rsvps"), wh.read("clean", "clean_membership"),
        wh.read("clean", "clean_events"), cfg)))
    q["fct_events_enriched"] = timed(name="fct_events_enriched", fn=lambda: drain(facts.fct_events_enriched(
        wh.read("analytics", "d_events"), wh.read("analytics", "d_teams"),
        wh.read("analytics", "d_geo_looker"), wh.read("analytics", "f_events_rsvps"), cfg)))

    def upsert_10pct():
        dim = wh.read("analytics", "d_membership")
        changed = (dim.where(F.xxhash64("membership_id") % 10 == 0)
                   .withColumn("role_title", F.concat("role_title", F.lit("*")))
                   .withColumn("etl_updated_date", F.current_timestamp()))
        sinks.upsert(spark, changed, wh.target("analytics", "d_membership"), "membership_id")
        wh.forget(wh.target("analytics", "d_membership"))
    q["snk_upsert_10pct"] = timed(name="snk_upsert_10pct", fn=upsert_10pct)
    q["met_new_vs_returning"] = timed(name="met_new_vs_returning", fn=lambda: drain(metrics.met_new_vs_returning(
        wh.read("analytics", "f_events_rsvps"), wh.read("analytics", "d_membership"))))
    day = JobConfig.for_day("2024-02-15")
    q["incremental_day"] = timed(name="incremental_day", fn=lambda: run_batch(spark, day, sources, root=root))

    out = {"metric": "total_sec", "value": round(sum(v for v in q.values() if v is not None), 3), "unit": "sec",
           "queries": q, "sf": sf}
    if ERRORS:
        out["errors"] = ERRORS
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
