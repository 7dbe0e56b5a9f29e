"""Analytical metrics and the aggregates layer over the published tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from huddle.functions import exprs as X
from huddle.operators.asof import as_of_join, intervals


def met_daily_active_teams(d_events: DataFrame) -> DataFrame:
    """Distinct teams with an event, per event day."""
    return (d_events.groupBy(X.to_date("event_start").alias("event_date"))
            .agg(F.countDistinct("team_id").alias("active_teams")))


def met_rsvp_summary(enriched: DataFrame) -> DataFrame:
    """Status breakdown per event (NULL counts kept for events without answers)."""
    return enriched.select("event_id", F.col("total_rsvps").alias("total"),
                           F.col("accepted_rsvps").alias("accepted"),
                           F.col("declined_rsvps").alias("declined"),
                           F.col("unanswered_rsvps").alias("unanswered"),
                           F.col("responded_members").alias("responded"))


def met_attendance_30d(f_rsvps: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Accepted over all latest answers whose p_date is in [as_of - 29, as_of]."""
    end = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    start = end - dt.timedelta(days=29)
    s = F.col("rsvp_status")
    return (f_rsvps.where(F.col("p_date").between(F.lit(start), F.lit(end))
                          & (F.col("is_latest_response") == F.lit(True)))
            .agg(F.count(F.lit(1)).alias("invites"), X.count_when(s == 1).alias("accepted"))
            .select(F.lit(end).alias("as_of"), "invites", "accepted",
                    X.rate_pct("accepted", "invites").alias("attendance_rate")))


def attendance_by_day(f_rsvps: DataFrame) -> DataFrame:
    """As of the end of every day with an answer: (event, member) pairs that have answered by then, and those
    whose answer in force is accepted. A pair counts from one answer to the next; days are running sums."""
    history = intervals(f_rsvps, ["event_id", "membership_id"], "responded_at", ["rsvp_status"], ["event_rsvp_id"])
    yes = (F.col("rsvp_status") == 1).cast("int")
    ends = F.array(F.struct(X.to_date("valid_from").alias("day"), F.lit(1).alias("pairs"), yes.alias("accepted")),
                   F.struct(X.to_date("valid_to").alias("day"), F.lit(-1).alias("pairs"), (-yes).alias("accepted")))
    days = (history.select(F.explode(ends).alias("e")).where(F.col("e.day").isNotNull())
            .groupBy("e.day").agg(F.sum("e.pairs").alias("pairs"), F.sum("e.accepted").alias("accepted")))
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)  # one row a day
    return (days.select(F.col("day").alias("as_of"), F.sum("pairs").over(so_far).alias("invites"),
                        F.sum("accepted").over(so_far).alias("accepted"))
            .withColumn("attendance_rate", X.rate_pct("accepted", "invites")))


def activity_streaks(f_rsvps: DataFrame) -> DataFrame:
    """(membership_id, streak_start, weeks, weeks_before): every run of consecutive weeks with an answer of a member,
    its length, and the weeks without one since the run before (null for a member's first).

    Answers are first reduced to one row per member and week, so a very active member costs a row a week.
    """
    weeks = (f_rsvps.where(F.col("responded_at").isNotNull())
             .select("membership_id", X.week_start("responded_at").alias("week")).distinct())
    # consecutive weeks, less seven days for each row before, share one day
    island = F.expr("date_sub(week, CAST(7 * row_number() OVER (PARTITION BY membership_id ORDER BY week) AS INT))")
    runs = (weeks.withColumn("island", island).groupBy("membership_id", "island")
            .agg(F.min("week").alias("streak_start"), F.max("week").alias("last_week"), F.count(F.lit(1)).alias("weeks")))
    before = F.lag("last_week").over(Window.partitionBy("membership_id").orderBy("streak_start"))
    gap = (F.datediff("streak_start", before) / 7 - 1).cast("bigint")
    return runs.select("membership_id", "streak_start", "weeks", gap.alias("weeks_before"))


def status_at_start(f_rsvps: DataFrame, d_events: DataFrame) -> DataFrame:
    """For every (event, member) pair with an answer: the answer in force when the event began (null: none yet)."""
    pairs = f_rsvps.select("event_id", "membership_id").distinct().join(d_events.select("event_id", "event_start"), "event_id")
    return as_of_join(pairs, f_rsvps, ["event_id", "membership_id"], "event_start", "responded_at",
                      ["event_rsvp_id", "rsvp_status"], ["event_rsvp_id"])


def met_new_vs_returning(f_rsvps: DataFrame, d_membership: DataFrame) -> DataFrame:
    """Per response week: members answering in their joining week (new), after
    it (returning), or before it (before_join). Weeks start on Monday and keep
    the year.

    Answers are first reduced to distinct (member, week) pairs (combined
    map-side), so a very active member costs one row per week before the join.
    """
    act = (f_rsvps.where(F.col("responded_at").isNotNull())
           .select("membership_id", X.week_start("responded_at").alias("week_start")).distinct())
    m = d_membership.select(F.col("membership_id").alias("__m"), X.week_start("joined_at").alias("__jw"))
    j = act.join(m, F.col("membership_id") == F.col("__m"), "inner")
    return (j.groupBy("week_start")
            .agg(X.count_when(F.col("__jw") == F.col("week_start")).alias("new_members"),
                 X.count_when(F.col("__jw") < F.col("week_start")).alias("returning_members"),
                 X.count_when(F.col("__jw") > F.col("week_start")).alias("before_join")))


def met_events_per_region(enriched: DataFrame) -> DataFrame:
    """Events per (country, region); NULL region is its own group."""
    return enriched.groupBy("country_code", "region").agg(F.count(F.lit(1)).alias("events"))


def activity_rollup(enriched: DataFrame) -> DataFrame:
    """Events, distinct teams and answers by (country, region, activity), by (country, region), by country and in all.

    One scan and one aggregation for all levels. ``level`` is the grouping id: bit 1 activity, bit 2 region, bit 4
    country summed over, which tells a total from a group whose region is null.
    """
    c, r, a = (F.col(x) for x in ("country_code", "region", "team_activity"))
    return (enriched.groupingSets([[c, r, a], [c, r], [c], []], c, r, a)
            .agg(F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("events"),
                 F.countDistinct("team_id").alias("active_teams"),
                 F.coalesce(F.sum("total_rsvps"), F.lit(0)).alias("total_rsvps")))


def fct_membership_enriched(f_rsvps: DataFrame, d_membership: DataFrame) -> DataFrame:
    """Per day: active members (answered that day), new members (joined that
    day), returning members (active, joined on an earlier day)."""
    act = f_rsvps.select(F.col("p_date").alias("activity_date"), "membership_id").distinct()
    m = d_membership.select(F.col("membership_id").alias("__m"), X.to_date("joined_at").alias("__jd"))
    daily = (act.join(m, F.col("membership_id") == F.col("__m"), "left")
             .groupBy("activity_date")
             .agg(F.count(F.lit(1)).alias("active_members"),
                  X.count_when(F.col("__jd") < F.col("activity_date")).alias("returning_members")))
    joined = (d_membership.groupBy(X.to_date("joined_at").alias("__day"))
              .agg(F.count(F.lit(1)).alias("new_members")))
    return (daily.join(joined, F.col("activity_date") == F.col("__day"), "full")
            .select(F.coalesce("activity_date", "__day").alias("activity_date"),
                    F.coalesce("active_members", F.lit(0)).alias("active_members"),
                    F.coalesce("new_members", F.lit(0)).alias("new_members"),
                    F.coalesce("returning_members", F.lit(0)).alias("returning_members"))
            .where(F.col("activity_date").isNotNull()))


def agg_weekly_monthly(enriched: DataFrame) -> DataFrame:
    """Weekly and monthly rollups of the enriched fact in one aggregation pass;
    the rate is recomputed from summed counts."""
    periods = F.array(
        F.struct(F.lit("week").alias("period"), X.week_start("event_start").alias("period_start")),
        F.struct(F.lit("month").alias("period"), X.month_start("event_start").alias("period_start")))
    g = (enriched.select("team_id", "total_rsvps", "accepted_rsvps", F.explode(periods).alias("p"))
         .groupBy(F.col("p.period").alias("period"), F.col("p.period_start").alias("period_start"))
         .agg(F.count(F.lit(1)).alias("events"),
              F.countDistinct("team_id").alias("active_teams"),
              F.coalesce(F.sum("total_rsvps"), F.lit(0)).alias("total_rsvps"),
              F.coalesce(F.sum("accepted_rsvps"), F.lit(0)).alias("accepted_rsvps")))
    return g.withColumn("attendance_rate", X.rate_pct("accepted_rsvps", "total_rsvps"))


def dim_date(start: Column | str, end: Column | str, frame: DataFrame | None = None) -> DataFrame:
    """Calendar rows for every day in [start, end]. ``start``/``end`` may be
    columns of a one-row ``frame`` (e.g. a min/max over the data)."""
    from pyspark.sql import SparkSession
    if frame is None:
        spark = SparkSession.getActiveSession()
        frame = spark.range(1).select(F.lit(start).cast("date").alias("__s"), F.lit(end).cast("date").alias("__e"))
    else:
        frame = frame.select(X.col(start).cast("date").alias("__s"), X.col(end).cast("date").alias("__e"))
    d = F.col("date")
    return (frame.where(F.col("__s").isNotNull() & F.col("__e").isNotNull())
            .select(F.explode(F.sequence("__s", "__e", F.expr("INTERVAL 1 DAY"))).alias("date"))
            .select("date",
                    (F.weekday(d) + 1).alias("day_of_week"),
                    F.weekofyear(d).alias("iso_week"),
                    X.week_start(d).alias("week_start"),
                    F.month(d).alias("month"),
                    X.month_start(d).alias("month_start"),
                    F.quarter(d).alias("quarter"),
                    F.year(d).alias("year")))


def data_date_span(*frames_and_cols: tuple[DataFrame, str]) -> DataFrame:
    """One row (lo, hi): the min and max date over the given (frame, column) pairs."""
    parts = [df.select(X.to_date(c).alias("d")) for df, c in frames_and_cols]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
