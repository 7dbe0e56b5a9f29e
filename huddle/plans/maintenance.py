"""Maintenance jobs: revalidate rejected rows, retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from huddle.config import JobConfig
from huddle.plans import clean


def not_valid_dates(old_clean: DataFrame) -> DataFrame:
    """Partitions holding at least one not-valid (FALSE or NULL) row."""
    return (old_clean.where(~F.coalesce(F.col("is_valid_record"), F.lit(False)))
            .select("p_date").distinct())


def revalidate(old_clean: DataFrame, recomputed: DataFrame, key: str) -> DataFrame:
    """Rows whose outcome (validity or error text) changed between two runs."""
    old = old_clean.select(F.col(key).alias("__k"), F.col("is_valid_record").alias("was_valid"),
                           F.col("validation_error").alias("old_error"))
    j = recomputed.join(old, F.col(key) == F.col("__k"), "inner")
    changed = ~(F.col("was_valid").eqNullSafe(F.col("is_valid_record"))
                & F.col("old_error").eqNullSafe(F.col("validation_error")))
    return j.where(changed).select(key, "p_date", "was_valid", "is_valid_record", "validation_error")


def revalidate_membership(old_clean: DataFrame, raw: DataFrame, teams: DataFrame, cfg: JobConfig) -> DataFrame:
    """Rerun the membership checks on partitions with not-valid rows against the
    current team table; return rows whose outcome changed (late parents)."""
    dates = not_valid_dates(old_clean)  # one row per partition day: bounded by the table's days
    raw_part = raw.join(dates, "p_date", "left_semi")
    return revalidate(old_clean, clean.clean_membership(raw_part, teams, cfg), "membership_id")


def retention_report(df: DataFrame, table: str, cutoff: str | dt.date) -> DataFrame:
    """Rows a retention run drops (p_date < cutoff, per partition) and the
    undated rows it keeps: (table_name, p_date, action, rows)."""
    c = F.lit(dt.date.fromisoformat(cutoff) if isinstance(cutoff, str) else cutoff)
    p = F.col("p_date")
    return (df.where((p < c) | p.isNull())
            .groupBy(F.lit(table).alias("table_name"), p.alias("p_date"),
                     F.when(p.isNull(), "keep_undated").otherwise("drop").alias("action"))
            .agg(F.count(F.lit(1)).alias("rows")))


def apply_retention(df: DataFrame, cutoff: str | dt.date) -> DataFrame:
    """The rows that stay: p_date >= cutoff, undated rows kept."""
    c = F.lit(dt.date.fromisoformat(cutoff) if isinstance(cutoff, str) else cutoff)
    return df.where((F.col("p_date") >= c) | F.col("p_date").isNull())


def run_retention(wh, layer: str, table: str, cutoff: str | dt.date) -> DataFrame:
    """Drop partitions older than ``cutoff`` from a p_date-partitioned table and
    return the report of what was dropped. No kept row is rewritten; undated rows
    are kept."""
    from huddle.operators import sinks

    df = wh.read(layer, table)
    report = retention_report(df, table, cutoff)
    rows = report.collect()  # one row per dropped day: a small, bounded list
    target = wh.target(layer, table)
    old_dates = sorted(r["p_date"] for r in rows if r["p_date"] is not None)
    if not old_dates:
        return wh.spark.createDataFrame(rows, report.schema)
    sinks.drop_partitions(wh.spark, target, "p_date", old_dates)
    wh.forget(target)
    return wh.spark.createDataFrame(rows, report.schema)
