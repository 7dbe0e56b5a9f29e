"""Adapter views: the four source entities and the geo boxes, derived from the
generic test tables (customer, orders, events, lineitem, nation).

The formulas are fixed by the test fixtures so that the Spark jobs and the SQL
oracle see the same inputs. Each frame also carries ``p_date`` as the raw layer
would write it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from huddle.operators.schema import with_p_date


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day_ts(base: str, offset: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), offset.cast("int")).cast("timestamp")


def raw_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    nk = F.col("c_nationkey") % 6
    return c.select(
        F.col("c_custkey").cast("string").alias("team_id"),
        F.col("c_mktsegment").alias("group_activity"),
        F.when(nk == 0, "NOR").when(nk == 1, "GBR").when(nk == 2, "USA")
         .when(nk == 3, "DEU").when(nk == 4, "SWE").alias("country_code"),
        _day_ts("2023-12-22", F.col("c_custkey") % 60).alias("created_at"),
    )


def raw_memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    cust = F.col("o_custkey").cast("string")
    return o.select(
        F.col("o_orderkey").cast("string").alias("membership_id"),
        F.when(F.col("o_orderkey") % 50 == 0, F.concat(F.lit("X"), cust)).otherwise(cust).alias("group_id"),
        F.col("o_orderpriority").alias("role_title"),
        _day_ts("2024-01-01", F.col("o_orderkey") % 45).alias("joined_at"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    eid = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    user = F.col("user_id").cast("string")
    return e.select(
        eid.cast("string").alias("event_id"),
        F.when(eid % 97 == 0, F.concat(F.lit("X"), user)).otherwise(user).alias("team_id"),
        ts.alias("event_start"),
        F.when(eid % 101 == 0, F.lit(None).cast("timestamp"))
         .when(eid % 53 == 0, ts - F.expr("INTERVAL 1 HOURS"))
         .otherwise(ts + F.expr("INTERVAL 90 MINUTES")).alias("event_end"),
        F.when(F.col("event_type") == "signup", F.lit(None)).otherwise((30 + eid % 41).cast("double")).alias("latitude"),
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise((eid % 140 - 125).cast("double")).alias("longitude"),
        ts.alias("created_at"),
    )


def raw_event_rsvps(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    rf = F.col("l_returnflag")
    return li.select(
        (ok * 10 + F.col("l_linenumber")).cast("string").alias("event_rsvp_id"),
        F.when(pk % 89 == 0, F.lit(-1)).otherwise((ok * 7 + sk % 3) % 10000).cast("string").alias("event_id"),
        (ok - ok % 4).cast("string").alias("membership_id"),
        F.when(pk % 61 == 0, 3).when(pk % 71 == 0, F.lit(None))
         .when(rf == "A", 1).when(rf == "R", 2).otherwise(0).cast("int").alias("rsvp_status"),
        F.when((rf == "N") & (F.col("l_linenumber") % 2 == 0), F.lit(None).cast("timestamp"))
         .otherwise(_day_ts("2024-01-01", pk % 60)).alias("responded_at"),
    )


def geo_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    c4 = k % 4
    return n.select(
        F.when(c4 == 0, "NOR").when(c4 == 1, "GBR").when(c4 == 2, "USA").otherwise("DEU").alias("country_code"),
        F.col("n_name").alias("state"),
        (30 + (k % 5) * 7).cast("double").alias("min_lat"),
        (-125 + (k * 11) % 100).cast("double").alias("min_lng"),
        (42 + (k % 5) * 7).cast("double").alias("max_lat"),
        (-85 + (k * 11) % 100).cast("double").alias("max_lng"),
    )


_TS_COL = {"teams": "created_at", "memberships": "joined_at", "events": "created_at",
           "event_rsvps": "responded_at"}
_BUILDERS = {"teams": raw_teams, "memberships": raw_memberships, "events": raw_events,
             "event_rsvps": raw_event_rsvps}


def raw(spark: SparkSession, sf_dir: str, entity: str, p_date: bool = True) -> DataFrame:
    """One raw entity as the raw layer stores it (with ``p_date`` by default)."""
    df = _BUILDERS[entity](spark, sf_dir)
    return with_p_date(df, _TS_COL[entity]) if p_date else df


def raw_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    out = {e: raw(spark, sf_dir, e) for e in _BUILDERS}
    out["geo_boxes"] = geo_boxes(spark, sf_dir)
    return out


WITHDRAWN_DAY, REINSTATED_DAY = "2024-01-28", "2024-01-29"


def with_withdrawals(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four entities (without p_date) with parents delivered again: withdrawn on one day, every second
    of them valid again on the next. A later row takes the place of an earlier one by sorting before it."""
    src = {e: raw(spark, sf_dir, e, p_date=False) for e in _BUILDERS}

    def day(d: str) -> Column:
        return F.lit(d).cast("date").cast("timestamp")

    def number(c: str) -> Column:
        return F.col(c).cast("bigint")

    t, m, e = src["teams"], src["memberships"], src["events"]
    teams = [t.where(number("team_id") % n == 0).select("team_id", F.lit(a).alias("group_activity"), F.lit(c).alias("country_code"),
                                                        day(d).alias("created_at"))
             for n, a, c, d in ((7, "!withdrawn", "SWE", WITHDRAWN_DAY), (14, "!back", "NOR", REINSTATED_DAY))]
    club = spark.range(1).select(F.lit(" club").alias("team_id"), F.lit("club").alias("group_activity"),
                                 F.lit("NOR").alias("country_code"), day(REINSTATED_DAY).alias("created_at"))
    members = [m.where(number("membership_id") % n == 0).select("membership_id", F.lit(g).alias("group_id"), "role_title",
                                                                day(d).alias("joined_at"))
               for n, g, d in ((11, "!none", WITHDRAWN_DAY), (22, " club", REINSTATED_DAY))]

    def moved(n: int, days: int, length: str, d: str) -> DataFrame:
        start = F.col("event_start") - F.expr(f"INTERVAL {days} DAYS")
        return e.where(number("event_id") % n == 0).select(
            "event_id", "team_id", start.alias("event_start"), (start + F.expr(f"INTERVAL {length} MINUTES")).alias("event_end"),
            "latitude", "longitude", day(d).alias("created_at"))
    events = [moved(13, 40, "-60", WITHDRAWN_DAY), moved(26, 50, "90", REINSTATED_DAY)]
    for name, more in (("teams", [*teams, club]), ("memberships", members), ("events", events)):
        for df in more:
            src[name] = src[name].unionByName(df)
    return src
