"""Clean layer: window, non-NULL key, one row per key, FK flags, checks.

Each function takes raw frames that already carry ``p_date`` and the *full*
clean reference tables it validates against (never only the run window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from huddle import config as C
from huddle.config import JobConfig
from huddle.functions import exprs as X
from huddle.functions.checks import Check, apply_checks
from huddle.operators.keys import asc, dedupe_by_key, desc, fk_flag, latest_flag
from huddle.sources.catalog import window_filter

RSVP_SURVIVOR = [desc("responded_at"), asc("event_id"), asc("membership_id"), asc("rsvp_status")]
LATEST_ORDER = [desc("responded_at")]


def _select_keyed(raw: DataFrame, key: str, cfg: JobConfig, order=None) -> DataFrame:
    df = window_filter(raw, cfg).where(F.col(key).isNotNull())
    return dedupe_by_key(df, key, order)


def valid_rows(clean: DataFrame) -> DataFrame:
    """is_valid_record = TRUE (NULL is not valid)."""
    return clean.where(F.col("is_valid_record"))


def invalid_rows(clean: DataFrame, include_undetermined: bool = True) -> DataFrame:
    """Rejected rows; NULL validity is reported too unless asked otherwise."""
    v = F.col("is_valid_record")
    return clean.where(~v | v.isNull()) if include_undetermined else clean.where(~v)


def prepare_teams(raw: DataFrame, cfg: JobConfig) -> DataFrame:
    return _select_keyed(raw, "team_id", cfg).select(
        "team_id", F.col("group_activity").alias("team_activity"), "country_code", "created_at", "p_date")


def validate_teams(df: DataFrame, cfg: JobConfig) -> DataFrame:
    return apply_checks(df, [Check("is_valid_country_code",
                                   F.col("country_code").isin(list(cfg.valid_country_codes)), C.MSG_COUNTRY)])


def clean_teams(raw: DataFrame, cfg: JobConfig) -> DataFrame:
    return validate_teams(prepare_teams(raw, cfg), cfg)


def prepare_membership(raw: DataFrame, cfg: JobConfig) -> DataFrame:
    return _select_keyed(raw, "membership_id", cfg).select(
        "membership_id", F.col("group_id").alias("team_id"), "role_title", "joined_at", "p_date")


def validate_membership(df: DataFrame, teams: DataFrame) -> DataFrame:
    df = fk_flag(df, "team_id", valid_rows(teams), "team_id", "is_valid_team_id")
    return apply_checks(df, [Check("is_valid_team_id", F.col("is_valid_team_id"), C.MSG_FK_TEAM)])


def clean_membership(raw: DataFrame, teams: DataFrame, cfg: JobConfig) -> DataFrame:
    return validate_membership(prepare_membership(raw, cfg), teams)


MEMBERSHIP_BASE = ["membership_id", "team_id", "role_title", "joined_at", "p_date"]
EVENT_BASE = ["event_id", "team_id", "event_start", "event_end", "latitude", "longitude", "created_at", "p_date"]
RSVP_BASE = ["event_rsvp_id", "event_id", "membership_id", "rsvp_status", "responded_at", "p_date"]
RSVP_COLUMNS = RSVP_BASE + ["rsvp_response", "is_latest_response", "is_valid_event_id", "is_valid_membership_id",
                            "is_valid_rsvp", "is_valid_record", "validation_error"]


def prepare_events(raw: DataFrame, cfg: JobConfig) -> DataFrame:
    return _select_keyed(raw, "event_id", cfg)


def validate_events(df: DataFrame, teams: DataFrame) -> DataFrame:
    df = fk_flag(df, "team_id", valid_rows(teams), "team_id", "is_valid_team_id")
    df = apply_checks(df, [
        Check("is_valid_team_id", F.col("is_valid_team_id"), C.MSG_FK_TEAM),
        Check("is_valid_timestamps", X.valid_timestamps(), C.MSG_TIMESTAMPS),
    ])
    return df.withColumns({"has_location": X.has_location(),
                           "event_duration_minutes": X.duration_minutes()})


def clean_events(raw: DataFrame, teams: DataFrame, cfg: JobConfig) -> DataFrame:
    return validate_events(prepare_events(raw, cfg), teams)


def rsvp_checks(cfg: JobConfig) -> list[Check]:
    return [
        Check("is_valid_event_id", F.col("is_valid_event_id"), C.MSG_FK_EVENT),
        Check("is_valid_membership_id", F.col("is_valid_membership_id"), C.MSG_FK_MEMBERSHIP),
        Check("is_valid_rsvp", F.col("rsvp_status").isin(list(cfg.valid_rsvp_statuses)), C.MSG_RSVP_STATUS),
    ]


def prepare_rsvps(raw: DataFrame, cfg: JobConfig) -> DataFrame:
    return _select_keyed(raw, "event_rsvp_id", cfg, RSVP_SURVIVOR).select(*RSVP_BASE)


def validate_rsvps(df: DataFrame, memberships: DataFrame, events: DataFrame, cfg: JobConfig) -> DataFrame:
    """FK flags, label and checks; keeps any columns already present (such as
    the latest flag)."""
    df = fk_flag(df, "membership_id", valid_rows(memberships), "membership_id", "is_valid_membership_id")
    df = fk_flag(df, "event_id", valid_rows(events), "event_id", "is_valid_event_id")
    df = df.withColumn("rsvp_response", X.rsvp_label())
    return apply_checks(df, rsvp_checks(cfg))


def clean_event_rsvps(raw: DataFrame, memberships: DataFrame, events: DataFrame, cfg: JobConfig, latest: bool = True) -> DataFrame:
    """RSVPs: survivor per key, latest answer per (event, member), FK and status checks.

    The latest flag is taken before the FK joins (it does not depend on them),
    while the rows are still partitioned by the key the flag is joined back on.
    ``latest=False`` leaves the flag null, for a merge that takes it over more rows.
    """
    if cfg.latest_among not in ("all", "valid"):
        raise ValueError(f"unknown latest_among {cfg.latest_among!r}")
    df = prepare_rsvps(raw, cfg)
    if latest and cfg.latest_among == "all":
        df = latest_flag(df, ["event_id", "membership_id"], LATEST_ORDER, "event_rsvp_id")
    df = validate_rsvps(df, memberships, events, cfg)
    if latest and cfg.latest_among == "valid":
        df = latest_flag(df, ["event_id", "membership_id"], LATEST_ORDER, "event_rsvp_id",
                         among=F.col("is_valid_record"))
    if not latest:
        df = df.withColumn("is_latest_response", F.lit(None).cast("boolean"))
    return df.select(*RSVP_COLUMNS)
