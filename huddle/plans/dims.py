"""Dimensions: valid clean rows in the window, fixed column lists, audit columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from huddle import schemas
from huddle.config import JobConfig
from huddle.operators import sinks
from huddle.plans.audit import add_audit
from huddle.sources.catalog import in_window, on_dates

DIMS = {
    "d_teams": ("clean_teams", "team_id", schemas.D_TEAMS),
    "d_membership": ("clean_membership", "membership_id", schemas.D_MEMBERSHIP),
    "d_events": ("clean_events", "event_id", schemas.D_EVENTS),
}


def dim_frame(clean: DataFrame, columns: list[str], cfg: JobConfig, audit: bool = True,
              extra_dates: list | None = None) -> DataFrame:
    """Valid rows of the window, and of further partitions that the run rewrote."""
    days = in_window(cfg)
    if extra_dates:
        days = days | on_dates(extra_dates)
    df = clean.where(days).where(F.col("is_valid_record") == F.lit(True)).select(*columns)
    return add_audit(df, cfg) if audit else df


def dim_teams(clean: DataFrame, cfg: JobConfig, audit: bool = True) -> DataFrame:
    return dim_frame(clean, schemas.D_TEAMS, cfg, audit)


def dim_membership(clean: DataFrame, cfg: JobConfig, audit: bool = True) -> DataFrame:
    return dim_frame(clean, schemas.D_MEMBERSHIP, cfg, audit)


def dim_events(clean: DataFrame, cfg: JobConfig, audit: bool = True) -> DataFrame:
    return dim_frame(clean, schemas.D_EVENTS, cfg, audit)


def load_dim(spark: SparkSession, frame: DataFrame, target: str, key: str, cfg: JobConfig, gone: DataFrame | None = None) -> None:
    """First load overwrites; later loads upsert on the key (created date kept) and delete the keys of ``gone``."""
    if cfg.full_load:
        sinks.write_full(frame, target, cfg.table_format)
    else:
        # frames of clean tables have one row per key
        sinks.upsert(spark, frame, target, key, "etl_created_date", cfg.table_format, unique=True, gone=gone)
