"""Audit columns: one run timestamp per run (or current_timestamp())."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from huddle.config import JobConfig


def run_ts(cfg: JobConfig) -> Column:
    return F.lit(cfg.run_ts).cast("timestamp") if cfg.run_ts else F.current_timestamp()


def add_audit(df: DataFrame, cfg: JobConfig, updated: bool = True) -> DataFrame:
    ts = run_ts(cfg)
    cols = {"etl_created_date": ts}
    if updated:
        cols["etl_updated_date"] = ts
    return df.withColumns(cols)
