"""Catalog or path tables, and the run window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from huddle.config import JobConfig
from huddle.operators.sinks import read_target


def read_table(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    return read_target(spark, target, fmt)


def run_window(cfg: JobConfig) -> tuple[dt.date, dt.date]:
    return dt.date.fromisoformat(cfg.start_date), dt.date.fromisoformat(cfg.end_date)


def in_window(cfg: JobConfig, col: str = "p_date"):
    """Inclusive window on a partition date column (pruned on partitioned tables;
    NULL never passes). With ``include_undated`` NULL dates pass too."""
    start, end = run_window(cfg)
    cond = F.col(col).between(F.lit(start), F.lit(end))
    return (cond | F.col(col).isNull()) if cfg.include_undated else cond


def on_dates(dates: list, col: str = "p_date"):
    """Rows of the given partition dates; None stands for the NULL partition. Never NULL itself."""
    days = [d for d in dates if d is not None]
    cond = F.coalesce(F.col(col).isin(days), F.lit(False)) if days else F.lit(False)
    return (cond | F.col(col).isNull()) if None in dates else cond


def window_filter(df: DataFrame, cfg: JobConfig, col: str = "p_date") -> DataFrame:
    return df.where(in_window(cfg, col))
