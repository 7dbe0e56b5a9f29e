"""Facts: the RSVP fact, the per-event enriched fact and the wide RSVP fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from huddle import schemas
from huddle.config import JobConfig
from huddle.functions import exprs as X
from huddle.operators.geo import with_region
from huddle.plans.audit import add_audit
from huddle.sources.catalog import window_filter


def fct_event_rsvps(clean_rsvps: DataFrame, cfg: JobConfig, audit: bool = True,
                    window: bool = True) -> DataFrame:
    df = clean_rsvps.where(F.col("is_valid_record") == F.lit(True))
    if window:
        df = window_filter(df, cfg)
    if audit:
        df = add_audit(df, cfg, updated=False)
        return df.select(*schemas.F_EVENTS_RSVPS, "etl_created_date")
    return df.select(*schemas.F_EVENTS_RSVPS)


def rsvp_summary(f_rsvps: DataFrame) -> DataFrame:
    """Per event over latest answers: total, accepted (1), declined (2),
    unanswered (0), responded (1 or 2). A partial+final hash aggregate."""
    s = F.col("rsvp_status")
    return (f_rsvps.where(F.col("is_latest_response") == F.lit(True))
            .groupBy("event_id")
            .agg(F.count(F.lit(1)).alias("total_rsvps"),
                 X.count_when(s == 1).alias("accepted_rsvps"),
                 X.count_when(s == 2).alias("declined_rsvps"),
                 X.count_when(s == 0).alias("unanswered_rsvps"),
                 X.count_when(s.isin(1, 2)).alias("responded_members")))


def events_with_teams(d_events: DataFrame, d_teams: DataFrame) -> DataFrame:
    """Events left-joined once to their team's attributes (used by the region
    lookup and by the final projection alike)."""
    t = d_teams.select(F.col("team_id").alias("__t_id"), "team_activity", "country_code")
    return (d_events.join(t, F.col("team_id") == F.col("__t_id"), "left").drop("__t_id"))


def fct_events_enriched(d_events: DataFrame, d_teams: DataFrame, geo: DataFrame, f_rsvps: DataFrame,
                        cfg: JobConfig, audit: bool = True) -> DataFrame:
    """One row per event: team attributes, region, RSVP counts, attendance rate.

    Events without RSVPs keep NULL counts and get rate 0.00.
    """
    et = events_with_teams(d_events, d_teams)
    et = with_region(et, geo, tie=cfg.region_tie)
    s = rsvp_summary(f_rsvps).withColumnRenamed("event_id", "__s_id")
    out = (et.join(s, F.col("event_id") == F.col("__s_id"), "left")
             .withColumns({"event_date": X.to_date("event_start"),
                           "event_attendance_rate": X.rate_pct("accepted_rsvps", "total_rsvps")})
             .select(*schemas.F_EVENTS_ENRICHED))
    return add_audit(out, cfg, updated=False) if audit else out


def fct_event_rsvps_wide(f_rsvps: DataFrame, d_events: DataFrame, d_teams: DataFrame,
                         d_membership: DataFrame) -> DataFrame:
    """RSVP fact plus the event's times, duration and team, the team's country and
    the member's role. ``team_id`` is the event's team."""
    e = d_events.select(F.col("event_id").alias("__e_id"), "event_start", "event_end",
                        "event_duration_minutes", "team_id")
    t = d_teams.select(F.col("team_id").alias("__t_id"), "country_code")
    m = d_membership.select(F.col("membership_id").alias("__m_id"), "role_title")
    return (f_rsvps.join(e, F.col("event_id") == F.col("__e_id"), "left")
                   .join(t, F.col("team_id") == F.col("__t_id"), "left")
                   .join(m, F.col("membership_id") == F.col("__m_id"), "left")
                   .drop("__e_id", "__t_id", "__m_id"))


def wide_view_sql(f_rsvps: str, d_events: str, d_teams: str, d_membership: str) -> str:
    """The wide RSVP fact over stored tables or views, as a view definition.

    A dimension has one row per key. Grouping by the key says so to the optimizer, which then leaves out the join
    with a dimension that a query takes no column of; the group has the partitioning that the join needs.
    """
    def by_key(table: str, key: str, *cols: str) -> str:
        return f"(SELECT {key}, {', '.join(f'max({c}) AS {c}' for c in cols)} FROM {table} GROUP BY {key})"
    e = by_key(d_events, "event_id", "event_start", "event_end", "event_duration_minutes", "team_id")
    return (f"SELECT f.*, e.event_start, e.event_end, e.event_duration_minutes, e.team_id, t.country_code, m.role_title "
            f"FROM {f_rsvps} f LEFT JOIN {e} e USING (event_id) "
            f"LEFT JOIN {by_key(d_teams, 'team_id', 'country_code')} t ON e.team_id = t.team_id "
            f"LEFT JOIN {by_key(d_membership, 'membership_id', 'role_title')} m ON f.membership_id = m.membership_id")
