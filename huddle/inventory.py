"""One Spark query per operator of the inventory, over the adapter views.

Every entry takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
match the SQL oracle in ``huddle.oracle``: timestamps leave as TIMESTAMP_NTZ
(UTC wall clock) and decimals as double, so the comparison does not depend on
session zone or decimal typing. Audit columns, which hold the run time, are
left out unless a fixed run timestamp is given.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cache, cached_property, partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from huddle import adapter, schemas
from huddle.config import JobConfig
from huddle.functions import exprs as X
from huddle.operators import geo as G, keys as K, schema as S, sinks
from huddle.plans import batch, clean, day_state, dims, drift, facts, maintenance, metrics, quality, raw
from huddle.session import prepare, scratch_path
from huddle.sources import catalog, files, quarantine
from huddle.streaming.daily import DailyStream
from huddle.streaming.incremental import revalidate_clean

# The probes read all dated rows of the fixtures; RANGE_CFG is for operators whose feature is a date range.
PROBE_CFG = JobConfig(start_date="2023-12-22")
RANGE_CFG = JobConfig(start_date="2024-01-01", end_date="2024-02-15")
PROBE_DAY = "2024-01-15"
OVERWRITE_DAY = "2024-01-10"
LOOKUP_DAY = "2024-01-30"
RUN_TS = dt.datetime(2024, 2, 16, 0, 0, 0)
EARLY_TS = dt.datetime(2024, 1, 1, 0, 0, 0)
LATE_TS = dt.datetime(2024, 3, 1, 0, 0, 0)
SPLIT_DAY = "2024-01-20"
RETENTION_CUTOFF = "2024-01-15"
CHAIN_BASE_END = "2024-01-27"
CHAIN_DAYS = ("2024-01-28", "2024-01-29")
CHAIN_REST = "2024-01-30"

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def probe(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def out(df: DataFrame) -> DataFrame:
    """Zone- and decimal-neutral output types."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


class Chain:
    """The whole layer chain over one sf folder, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: JobConfig = PROBE_CFG):
        self.spark = prepare(spark)
        self.sf = sf_dir
        self.cfg = cfg

    def raw(self, entity: str, p_date: bool = True) -> DataFrame:
        return adapter.raw(self.spark, self.sf, entity, p_date)

    @cached_property
    def geo(self) -> DataFrame:
        return adapter.geo_boxes(self.spark, self.sf)

    @cached_property
    def clean_teams(self) -> DataFrame:
        return clean.clean_teams(self.raw("teams"), self.cfg)

    @cached_property
    def clean_membership(self) -> DataFrame:
        return clean.clean_membership(self.raw("memberships"), self.clean_teams, self.cfg)

    @cached_property
    def clean_events(self) -> DataFrame:
        return clean.clean_events(self.raw("events"), self.clean_teams, self.cfg)

    @cached_property
    def clean_rsvps(self) -> DataFrame:
        return clean.clean_event_rsvps(self.raw("event_rsvps"), self.clean_membership, self.clean_events, self.cfg)

    @cached_property
    def d_teams(self) -> DataFrame:
        return dims.dim_teams(self.clean_teams, self.cfg, audit=False)

    @cached_property
    def d_membership(self) -> DataFrame:
        return dims.dim_membership(self.clean_membership, self.cfg, audit=False)

    @cached_property
    def d_events(self) -> DataFrame:
        return dims.dim_events(self.clean_events, self.cfg, audit=False)

    @cached_property
    def f_rsvps(self) -> DataFrame:
        return facts.fct_event_rsvps(self.clean_rsvps, self.cfg, audit=False)

    @cached_property
    def enriched(self) -> DataFrame:
        return facts.fct_events_enriched(self.d_events, self.d_teams, self.geo, self.f_rsvps, self.cfg,
                                         audit=False)

    @cached_property
    def wide(self) -> DataFrame:
        return facts.fct_event_rsvps_wide(self.f_rsvps, self.d_events, self.d_teams, self.d_membership)

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    def temp_view(self, df: DataFrame, name: str) -> str:
        v = f"{name}_{uuid.uuid4().hex[:8]}"
        df.createOrReplaceTempView(v)
        return v


def chain(spark: SparkSession, sf_dir: str) -> Chain:
    return Chain(spark, sf_dir)


def write_events_with_bad_lines(c: Chain, path: str) -> None:
    """The events as CSV lines, some of them planted: a field too many, fields cut off, values of the wrong type."""
    ev = c.raw("events", p_date=False)
    n = F.col("event_id").cast("bigint")
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    texts = [F.coalesce(F.date_format(f.name, fmt) if isinstance(f.dataType, T.TimestampType) else F.col(f.name).cast("string"),
                        F.lit("")) for f in schemas.EVENTS.fields]
    texts[2] = F.when(n % 29 == 0, "soon").otherwise(texts[2])
    texts[4] = F.when(n % 31 == 0, "north").otherwise(texts[4])
    line = F.concat_ws(",", *texts)
    line = F.when(n % 19 == 0, F.concat(line, F.lit(",more"))).when(n % 23 == 0, F.concat_ws(",", *texts[:3])).otherwise(line)
    # a separator that no line has, so that lines and header are written as they are
    (ev.select(line.alias(",".join(schemas.EVENTS.names))).write.option("header", True).option("sep", "\u0001")
     .option("quote", "").csv(path))


def load_events_checked(spark: SparkSession, sf: str) -> tuple[str, str, str]:
    """Paths of the CSV with planted lines, the raw table and the quarantine."""
    c = chain(spark, sf)
    path, table, bad = (c.scratch(f"events-bad-{n}") for n in ("csv", "raw", "lines"))
    write_events_with_bad_lines(c, path)
    quarantine.load_checked(c.spark, path, "events", table, bad)
    return path, table, bad


# --------------------------------------------------------------------------
# 2.1 scans and sources
# --------------------------------------------------------------------------
@probe("src_csv")
def src_csv(spark, sf):
    c = chain(spark, sf)
    path = c.scratch("events-csv")
    files.write_csv(c.raw("events", p_date=False), path)
    return out(files.read_entity_csv(spark, path, schemas.EVENTS))


@probe("src_quarantine")
def src_quarantine(spark, sf):
    """Every delivered event line by where it went: the raw table (no reason) or the quarantine."""
    _, table, bad = load_events_checked(spark, sf)
    return (spark.read.parquet(table).select("event_id", F.lit(None).cast("string").alias("reason"))
            .unionByName(spark.read.parquet(bad).select(F.split("line", ",")[0].alias("event_id"), "reason")))


@probe("dq_line_account")
def dq_line_account(spark, sf):
    path, table, bad = load_events_checked(spark, sf)
    return quarantine.line_account(spark, path, spark.read.parquet(table), spark.read.parquet(bad), "events")


@probe("src_csv_geo")
def src_csv_geo(spark, sf):
    c = chain(spark, sf)
    path = c.scratch("geo-csv")
    files.write_csv(c.geo.withColumnRenamed("country_code", "countryCode"), path)
    return out(files.read_geo_csv(spark, path))


@probe("src_csv_count")
def src_csv_count(spark, sf):
    c = chain(spark, sf)
    path = c.scratch("rsvps-csv")
    files.write_csv(c.raw("event_rsvps", p_date=False), path)
    return files.count_csv_rows(spark, path).withColumnRenamed("rows", "row_count")


@probe("src_table")
def src_table(spark, sf):
    c = chain(spark, sf)
    path = c.scratch("raw-events")
    sinks.write_partitioned(c.raw("events"), path, "p_date")
    return out(catalog.read_table(spark, path))


@probe("src_run_window")
def src_run_window(spark, sf):
    c = chain(spark, sf)
    day = JobConfig.for_day(PROBE_DAY)
    return out(catalog.window_filter(c.raw("event_rsvps"), day))


# --------------------------------------------------------------------------
# 2.2 schema operators
# --------------------------------------------------------------------------
@probe("sch_declare")
def sch_declare(spark, sf):
    c = chain(spark, sf)
    parts = []
    for entity, (schema, _, _, _) in schemas.ENTITIES.items():
        df = S.cast_to_schema(c.raw(entity, p_date=False), schema)
        row = df.agg(*[F.count(f.name).alias(f.name) for f in schema.fields])
        stack = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', {i + 1}, `{f.name}`"
                          for i, f in enumerate(schema.fields))
        parts.append(row.select(F.lit(entity).alias("entity"), F.expr(
            f"stack({len(schema.fields)}, {stack}) AS (column_name, data_type, position, non_null_values)")))
    return reduce(lambda a, b: a.unionByName(b), parts)


@probe("sch_cast")
def sch_cast(spark, sf):
    c = chain(spark, sf)
    r = c.raw("event_rsvps", p_date=False)
    strings = r.select(*[F.col(n).cast("string").alias(n.upper()) for n in r.columns]).withColumn(
        "RSVP_STATUS", F.when(F.col("RSVP_STATUS") == "3", F.lit("three")).otherwise(F.col("RSVP_STATUS")))
    return out(S.cast_to_schema(strings, schemas.EVENT_RSVPS))


GATE_CASES = ("exact", "extra", "reordered", "missing", "wrong_type")


def _gate_variant(df: DataFrame, case: str) -> DataFrame:
    if case == "extra":
        return df.withColumn("extra_col", F.lit(1))
    if case == "reordered":
        return df.select(*reversed(df.columns))
    if case == "missing":
        return df.drop(df.columns[-1])
    if case == "wrong_type":
        return df.withColumn(df.columns[-1], F.col(df.columns[-1]).cast("string"))
    return df


@probe("sch_gate")
def sch_gate(spark, sf):
    c = chain(spark, sf)
    parts = []
    for entity, (schema, _, _, _) in schemas.ENTITIES.items():
        base = S.cast_to_schema(c.raw(entity, p_date=False), schema)
        for case in GATE_CASES:
            v = _gate_variant(base, case)
            try:
                S.gate(v, schema, entity)
                ok, diff = True, ""
            except S.SchemaMismatch as e:
                ok, diff = False, str(e.diff)
            parts.append(v.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(entity).alias("entity"), F.lit(case).alias("case_name"), F.lit(ok).alias("ok"),
                F.lit(diff).alias("diff"),
                (F.col("n") if ok else F.lit(0).cast("long")).alias("rows_passed")))
    return reduce(lambda a, b: a.unionByName(b), parts)


@probe("sch_p_date")
def sch_p_date(spark, sf):
    c = chain(spark, sf)
    return out(S.with_p_date(c.raw("event_rsvps", p_date=False), "responded_at")
               .select("event_rsvp_id", "responded_at", "p_date"))


# --------------------------------------------------------------------------
# 2.3 sinks
# --------------------------------------------------------------------------
@probe("snk_partitioned")
def snk_partitioned(spark, sf):
    c = chain(spark, sf)
    path = c.scratch("snk-partitioned")
    r = c.raw("event_rsvps")
    sinks.write_partitioned(r, path, "p_date")
    day = r.where(F.col("p_date") == F.lit(OVERWRITE_DAY).cast("date")).withColumn("rsvp_status", F.lit(9))
    sinks.write_partitioned(day, path, "p_date", dynamic=True)
    return out(spark.read.parquet(path).select(*r.columns))


@probe("snk_full")
def snk_full(spark, sf):
    c = chain(spark, sf)
    path = c.scratch("snk-full")
    sinks.write_full(c.d_teams.limit(1), path)
    sinks.write_full(c.d_teams, path)
    return out(spark.read.parquet(path))


def _membership_dim_between(c: Chain, start: str | None, end: str | None, ts: dt.datetime,
                            changed: bool = False) -> DataFrame:
    d = c.d_membership
    day = X.to_date("joined_at")
    if start:
        d = d.where(day >= F.lit(start).cast("date"))
    if end:
        d = d.where(day < F.lit(end).cast("date"))
    if changed:
        d = d.withColumn("role_title", F.concat(F.col("role_title"), F.lit("*")))
    t = F.lit(ts).cast("timestamp")
    return d.withColumns({"etl_created_date": t, "etl_updated_date": t})


@probe("snk_upsert")
def snk_upsert(spark, sf):
    """Target: memberships joined before 2024-02-01. Source: those joined from
    2024-01-20 on, with a changed role. Overlap updates (created date kept),
    the rest inserts, earlier rows stay."""
    c = chain(spark, sf)
    path = c.scratch("snk-upsert")
    sinks.write_full(_membership_dim_between(c, None, "2024-02-01", EARLY_TS), path)
    src = _membership_dim_between(c, SPLIT_DAY, None, LATE_TS, changed=True)
    sinks.upsert(spark, src, path, "membership_id")
    return out(spark.read.parquet(path))


@probe("snk_view")
def snk_view(spark, sf):
    c = chain(spark, sf)
    path = c.scratch("f-rsvps")
    sinks.write_partitioned(c.f_rsvps, path, "p_date")
    view = f"v_f_events_rsvps_{uuid.uuid4().hex[:8]}"
    sinks.create_view(spark, view, path)
    return out(spark.table(view).select(*schemas.F_EVENTS_RSVPS))


@probe("snk_temp_view")
def snk_temp_view(spark, sf):
    c = chain(spark, sf)
    v = c.temp_view(c.clean_teams, "temp_etl_view")
    return out(spark.sql(f"SELECT team_id, team_activity, country_code, is_valid_record FROM {v}"))


@probe("snk_load_mode")
def snk_load_mode(spark, sf):
    """Full load of the window vs first load of January plus an incremental
    (upsert) load of February: both must hold the same dimension rows."""
    c = chain(spark, sf)
    full_path, inc_path = c.scratch("mode-full"), c.scratch("mode-incr")
    cfg_full = PROBE_CFG.with_(run_ts=RUN_TS)
    dims.load_dim(spark, dims.dim_teams(c.clean_teams, cfg_full), full_path, "team_id", cfg_full)
    first = PROBE_CFG.with_(end_date="2024-01-31", run_ts=EARLY_TS)
    dims.load_dim(spark, dims.dim_teams(c.clean_teams, first), inc_path, "team_id", first)
    daily = PROBE_CFG.with_(start_date="2024-02-01", full_load=False, run_ts=LATE_TS)
    dims.load_dim(spark, dims.dim_teams(c.clean_teams, daily), inc_path, "team_id", daily)
    cols = schemas.D_TEAMS
    return out(spark.read.parquet(full_path).select(F.lit("full").alias("load_mode"), *cols)
               .unionByName(spark.read.parquet(inc_path).select(F.lit("incremental").alias("load_mode"), *cols)))


# --------------------------------------------------------------------------
# 2.4 projections
# --------------------------------------------------------------------------
@probe("prj_rename")
def prj_rename(spark, sf):
    c = chain(spark, sf)
    return out(c.raw("memberships").select("membership_id", F.col("group_id").alias("team_id"),
                                           "role_title", "joined_at"))


@probe("prj_dim")
def prj_dim(spark, sf):
    """Every dimension's own column list, with the rows and distinct keys it publishes."""
    c = chain(spark, sf)
    parts = [getattr(c, name).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("keys"))
             .select(F.lit(name).alias("dim"), F.lit(", ".join(getattr(c, name).columns)).alias("columns"), "rows", "keys")
             for name, (_, key, _) in dims.DIMS.items()]
    return reduce(DataFrame.unionByName, parts)


@probe("prj_dim_rows")
def prj_dim_rows(spark, sf):
    """Every projected value of every dimension, one row per row of a dimension."""
    c = chain(spark, sf)
    parts = [getattr(c, name).withColumn("dim", F.lit(name)) for name in dims.DIMS]
    return out(reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts))


@probe("prj_fact")
def prj_fact(spark, sf):
    """The fact's projection of every valid clean answer, without the run window."""
    c = chain(spark, sf)
    return out(facts.fct_event_rsvps(c.clean_rsvps, RANGE_CFG, audit=False, window=False))


@probe("prj_drop")
def prj_drop(spark, sf):
    """Clean events without their check columns."""
    return out(chain(spark, sf).clean_events.drop("is_valid_team_id", "is_valid_timestamps", "validation_error"))


@probe("prj_star_sql")
def prj_star_sql(spark, sf):
    """A star query in SQL over the published frames: answers per country, region and role."""
    c = chain(spark, sf)
    wide, events = c.temp_view(c.wide, "wide"), c.temp_view(c.enriched, "enriched")
    return out(spark.sql(f"""
        SELECT w.country_code, ev.region, w.role_title, count(*) AS answers,
               count(DISTINCT w.event_id) AS events, count_if(w.rsvp_status = 1) AS accepted
        FROM {wide} w LEFT JOIN {events} ev USING (event_id)
        GROUP BY w.country_code, ev.region, w.role_title"""))


@probe("prj_audit")
def prj_audit(spark, sf):
    c = chain(spark, sf)
    cfg = PROBE_CFG.with_(run_ts=RUN_TS)
    return out(dims.dim_teams(c.clean_teams, cfg).select("team_id", "etl_created_date", "etl_updated_date"))


@probe("prj_transform")
def prj_transform(spark, sf):
    c = chain(spark, sf)
    return out(c.raw("teams")
               .transform(partial(catalog.window_filter, cfg=PROBE_CFG))
               .transform(lambda d: d.where(F.col("team_id").isNotNull()))
               .transform(partial(K.dedupe_by_key, key="team_id")))


# --------------------------------------------------------------------------
# 2.5 filters
# --------------------------------------------------------------------------
@probe("flt_date_range")
def flt_date_range(spark, sf):
    c = chain(spark, sf)
    return out(catalog.window_filter(c.raw("event_rsvps"), RANGE_CFG))


@probe("flt_pk_not_null")
def flt_pk_not_null(spark, sf):
    c = chain(spark, sf)
    return out(c.raw("event_rsvps").where(F.col("event_rsvp_id").isNotNull()).select("event_rsvp_id", "event_id"))


@probe("flt_valid")
def flt_valid(spark, sf):
    return out(clean.valid_rows(chain(spark, sf).clean_events).select("event_id", "is_valid_record"))


@probe("flt_invalid")
def flt_invalid(spark, sf):
    return out(clean.invalid_rows(chain(spark, sf).clean_rsvps)
               .select("event_rsvp_id", "is_valid_record", "validation_error"))


@probe("flt_latest")
def flt_latest(spark, sf):
    return out(chain(spark, sf).f_rsvps.where(F.col("is_latest_response") == F.lit(True))
               .select("event_rsvp_id", "event_id", "membership_id"))


@probe("flt_rank_one")
def flt_rank_one(spark, sf):
    c = chain(spark, sf)
    m = G.box_matches(facts.events_with_teams(c.d_events, c.d_teams), c.geo)
    return out(K.rank_one(m, ["event_id"], [F.col("state").asc_nulls_first()])
               .select("event_id", F.col("state").alias("region")))


@probe("flt_in_set")
def flt_in_set(spark, sf):
    c = chain(spark, sf)
    return out(c.clean_teams.where(F.col("country_code").isin(list(PROBE_CFG.valid_country_codes)))
               .select("team_id", "country_code"))


@probe("flt_not_in")
def flt_not_in(spark, sf):
    c = chain(spark, sf)
    return out(c.clean_rsvps.where(~F.col("rsvp_status").isin(list(PROBE_CFG.valid_rsvp_statuses)))
               .select("event_rsvp_id", "rsvp_status"))


@probe("flt_is_null")
def flt_is_null(spark, sf):
    c = chain(spark, sf)
    return out(c.raw("event_rsvps").where(F.col("responded_at").isNull() | F.col("rsvp_status").isNull())
               .select("event_rsvp_id", "rsvp_status", "responded_at"))


@probe("flt_like")
def flt_like(spark, sf):
    c = chain(spark, sf)
    return out(c.clean_rsvps.where(F.col("validation_error").like("%event_id%"))
               .select("event_rsvp_id", "validation_error"))


@probe("flt_cast_date_eq")
def flt_cast_date_eq(spark, sf):
    c = chain(spark, sf)
    return out(c.d_membership.where(X.to_date("joined_at") == F.lit(LOOKUP_DAY).cast("date"))
               .select("membership_id", "joined_at"))


@probe("flt_point_lookup")
def flt_point_lookup(spark, sf):
    """One pair's answers, by equality on both ids (pushed to the scan). The pair is
    the smallest with the most answers, so the probe holds on any data."""
    c = chain(spark, sf)
    raw = c.raw("event_rsvps")
    pair = (raw.groupBy("event_id", "membership_id").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "event_id", "membership_id").first())
    want = (F.lit(pair["event_id"]), F.lit(pair["membership_id"])) if pair else (F.lit(None), F.lit(None))
    return out(raw.where((F.col("event_id") == want[0]) & (F.col("membership_id") == want[1]))
               .select("event_rsvp_id", "event_id", "membership_id", "rsvp_status", "responded_at"))


# --------------------------------------------------------------------------
# 2.6 joins
# --------------------------------------------------------------------------
def _dedup_events(c: Chain) -> DataFrame:
    return K.dedupe_by_key(catalog.window_filter(c.raw("events"), PROBE_CFG)
                           .where(F.col("event_id").isNotNull()), "event_id")


def _dedup_rsvps(c: Chain) -> DataFrame:
    return K.dedupe_by_key(catalog.window_filter(c.raw("event_rsvps"), PROBE_CFG)
                           .where(F.col("event_rsvp_id").isNotNull()), "event_rsvp_id", clean.RSVP_SURVIVOR)


@probe("jon_fk_team")
def jon_fk_team(spark, sf):
    c = chain(spark, sf)
    df = K.fk_flag(_dedup_events(c), "team_id", clean.valid_rows(c.clean_teams), "team_id", "is_valid_team_id")
    return out(df.select("event_id", "team_id", "is_valid_team_id"))


@probe("jon_fk_membership")
def jon_fk_membership(spark, sf):
    c = chain(spark, sf)
    df = K.fk_flag(_dedup_rsvps(c), "membership_id", clean.valid_rows(c.clean_membership), "membership_id",
                   "is_valid_membership_id")
    return out(df.select("event_rsvp_id", "membership_id", "is_valid_membership_id"))


@probe("jon_fk_event")
def jon_fk_event(spark, sf):
    c = chain(spark, sf)
    df = K.fk_flag(_dedup_rsvps(c), "event_id", clean.valid_rows(c.clean_events), "event_id",
                   "is_valid_event_id")
    return out(df.select("event_rsvp_id", "event_id", "is_valid_event_id"))


@probe("jon_inner_equi")
def jon_inner_equi(spark, sf):
    c = chain(spark, sf)
    t = c.d_teams.select("team_id", "country_code")
    return out(c.d_events.join(t, "team_id", "inner").select("event_id", "team_id", "country_code"))


@probe("jon_geo_range")
def jon_geo_range(spark, sf):
    c = chain(spark, sf)
    et = c.d_events.join(c.d_teams.select("team_id", "country_code"), "team_id", "inner")
    return out(G.box_matches(et, c.geo).select("event_id", F.col("state").alias("region")))


@probe("jon_star_left")
def jon_star_left(spark, sf):
    return out(chain(spark, sf).enriched.select("event_id", "team_activity", "region", "total_rsvps"))


@probe("jon_anti")
def jon_anti(spark, sf):
    c = chain(spark, sf)
    r = catalog.window_filter(c.raw("event_rsvps"), PROBE_CFG)
    m = K.orphans(r, "membership_id", clean.valid_rows(c.clean_membership), "membership_id")
    e = K.orphans(r, "event_id", clean.valid_rows(c.clean_events), "event_id")
    return out(m.select(F.lit("membership_id").alias("fk"), "event_rsvp_id", F.col("membership_id").alias("fk_value"))
               .unionByName(e.select(F.lit("event_id").alias("fk"), "event_rsvp_id",
                                     F.col("event_id").alias("fk_value"))))


@probe("jon_using_chain")
def jon_using_chain(spark, sf):
    c = chain(spark, sf)
    r = catalog.window_filter(c.raw("event_rsvps"), PROBE_CFG).select("event_id", "membership_id")
    j = (r.join(c.clean_events.select("event_id"), "event_id")
          .join(c.clean_membership.select("membership_id"), "membership_id"))
    return j.agg(F.count(F.lit(1)).alias("survivors"))


def geo_diag(c: Chain) -> DataFrame:
    e = c.raw("events").select("event_id", "team_id", "latitude", "longitude")
    t = c.raw("teams").select("team_id", "country_code")
    m = G.box_matches(e.join(t, "team_id"), c.geo, has_loc=None)
    cols = ["country_code", "state", "latitude", "min_lat", "max_lat", "longitude", "min_lng", "max_lng"]
    return m.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


@probe("jon_geo_diag")
def jon_geo_diag(spark, sf):
    return out(geo_diag(chain(spark, sf)))


# --------------------------------------------------------------------------
# 2.7 dedupe and aggregation
# --------------------------------------------------------------------------
@probe("ded_pk")
def ded_pk(spark, sf):
    return out(_dedup_rsvps(chain(spark, sf)))


@probe("ded_distinct")
def ded_distinct(spark, sf):
    c = chain(spark, sf)
    return out(K.distinct_keys(clean.valid_rows(c.clean_events), "event_id"))


@probe("agg_rsvp_summary")
def agg_rsvp_summary(spark, sf):
    return out(facts.rsvp_summary(chain(spark, sf).f_rsvps))


@probe("agg_global_count")
def agg_global_count(spark, sf):
    return chain(spark, sf).clean_rsvps.agg(F.count(F.lit(1)).alias("n"))


@probe("agg_count_distinct_by_flag")
def agg_count_distinct_by_flag(spark, sf):
    r = chain(spark, sf).clean_rsvps
    a = (clean.valid_rows(r).groupBy(F.col("is_latest_response").alias("flag_value"))
         .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("event_rsvp_id").alias("distinct_rsvps"))
         .select(F.lit("is_latest_response").alias("flag_name"), "flag_value", "rows", "distinct_rsvps"))
    b = (r.groupBy(F.col("is_valid_record").alias("flag_value"))
         .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("event_rsvp_id").alias("distinct_rsvps"))
         .select(F.lit("is_valid_record").alias("flag_name"), "flag_value", "rows", "distinct_rsvps"))
    return a.unionByName(b)


@probe("agg_error_breakdown")
def agg_error_breakdown(spark, sf):
    r = chain(spark, sf).clean_rsvps
    return r.groupBy("validation_error").agg(F.countDistinct("event_rsvp_id").alias("rsvps"))


@probe("agg_group_by_all")
def agg_group_by_all(spark, sf):
    c = chain(spark, sf)
    v, t = c.temp_view(c.clean_rsvps, "clean_events_rsvps"), c.temp_view(c.clean_teams, "clean_teams")
    by_flags = spark.sql(f"SELECT 'flags' AS kind, CAST(is_valid_record AS STRING) AS a, "
                         f"CAST(is_latest_response AS STRING) AS b, count(*) AS n FROM {v} GROUP BY ALL")
    every = spark.sql(f"SELECT 'team' AS kind, a, b, n FROM (SELECT *, count(*) AS n FROM "
                      f"(SELECT country_code AS a, team_activity AS b FROM {t}) GROUP BY ALL)")
    return by_flags.unionByName(every)


@probe("agg_multi_key")
def agg_multi_key(spark, sf):
    """Events and boxes by the location and box columns that a region check looks at."""
    c = chain(spark, sf)
    keys = ["event_id", "team_id", "country_code", "state", "latitude", "min_lat", "max_lat", "longitude", "min_lng", "max_lng"]
    m = G.box_matches(facts.events_with_teams(c.d_events, c.d_teams), c.geo)
    return out(m.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))


@probe("agg_daily_distinct")
def agg_daily_distinct(spark, sf):
    e = chain(spark, sf).enriched
    return out(e.groupBy("event_date").agg(F.countDistinct("team_id").alias("teams")))


# --------------------------------------------------------------------------
# 2.8 windows
# --------------------------------------------------------------------------
@probe("win_latest")
def win_latest(spark, sf):
    c = chain(spark, sf)
    df = K.latest_flag(_dedup_rsvps(c), ["event_id", "membership_id"], clean.LATEST_ORDER, "event_rsvp_id")
    return out(df.select("event_rsvp_id", "event_id", "membership_id", "is_latest_response"))


@probe("win_region_pick")
def win_region_pick(spark, sf):
    c = chain(spark, sf)
    et = c.d_events.join(c.d_teams.select("team_id", "country_code"), "team_id", "inner")
    return out(G.with_region(et, c.geo).select("event_id", "region"))


# --------------------------------------------------------------------------
# 2.9 limit and set operations
# --------------------------------------------------------------------------
@probe("lim_preview")
def lim_preview(spark, sf):
    return out(chain(spark, sf).clean_teams.orderBy("team_id").limit(5))


@probe("set_union_counts")
def set_union_counts(spark, sf):
    c = chain(spark, sf)
    raw_n = c.raw("event_rsvps").agg(F.count(F.lit(1)).alias("n")).select("n", F.lit("raw").alias("table_name"))
    cln_n = c.clean_rsvps.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit("clean").alias("table_name"))
    return raw_n.union(cln_n).distinct()


# --------------------------------------------------------------------------
# 2.10 scalar functions
# --------------------------------------------------------------------------
@probe("fn_cast")
def fn_cast(spark, sf):
    e = chain(spark, sf).raw("events")
    return out(e.select("event_id", F.col("event_id").cast("long").alias("event_id_num"),
                        F.col("longitude").cast("long").alias("lng_whole"),
                        F.col("event_start").cast("date").alias("start_date")))


@probe("fn_to_date")
def fn_to_date(spark, sf):
    e = chain(spark, sf).raw("events")
    return out(e.select("event_id", X.to_date("event_start").alias("event_date"),
                        X.to_date("created_at").alias("created_date")))


@probe("fn_current_timestamp")
def fn_current_timestamp(spark, sf):
    r = chain(spark, sf).f_rsvps
    return r.select("event_rsvp_id", (F.current_timestamp() > F.col("responded_at")).alias("audit_after_response"))


@probe("fn_case_map")
def fn_case_map(spark, sf):
    r = _dedup_rsvps(chain(spark, sf))
    return out(r.select("event_rsvp_id", "rsvp_status", X.rsvp_label().alias("rsvp_response")))


@probe("fn_case_count")
def fn_case_count(spark, sf):
    r = chain(spark, sf).clean_rsvps
    s = F.col("rsvp_status")
    return r.groupBy("membership_id").agg(X.count_when(s == 1).alias("accepted"),
                                          X.count_when(s.isin(1, 2)).alias("responded"))


@probe("fn_case_guard")
def fn_case_guard(spark, sf):
    return out(chain(spark, sf).enriched.select("event_id", "event_attendance_rate"))


@probe("fn_concat_ws")
def fn_concat_ws(spark, sf):
    return out(chain(spark, sf).clean_events.select("event_id", "validation_error"))


@probe("fn_lit")
def fn_lit(spark, sf):
    d = chain(spark, sf).d_events
    return d.select("event_id", F.lit("d_events").alias("source_tag"), F.lit(True).alias("flag"),
                    F.lit(None).cast("string").alias("nothing"))


@probe("fn_bool_logic")
def fn_bool_logic(spark, sf):
    e = chain(spark, sf).clean_events
    return e.select("event_id", "is_valid_team_id", "is_valid_timestamps", "is_valid_record",
                    (~F.col("is_valid_record")).alias("is_rejected"))


@probe("fn_null_tests")
def fn_null_tests(spark, sf):
    e = chain(spark, sf).raw("events")
    return e.select("event_id", F.col("event_end").isNull().alias("no_end"),
                    F.col("latitude").isNotNull().alias("has_lat"))


@probe("fn_has_location")
def fn_has_location(spark, sf):
    e = chain(spark, sf).raw("events")
    return e.select("event_id", X.has_location().alias("has_location"))


@probe("fn_ts_compare")
def fn_ts_compare(spark, sf):
    e = chain(spark, sf).raw("events")
    return e.select("event_id", X.valid_timestamps().alias("ordered"))


@probe("fn_duration_minutes")
def fn_duration_minutes(spark, sf):
    e = chain(spark, sf).raw("events")
    return e.select("event_id", X.duration_minutes().alias("event_duration_minutes"))


@probe("fn_between")
def fn_between(spark, sf):
    e = chain(spark, sf).raw("events")
    return e.select("event_id", F.col("latitude").between(35.0, 50.0).alias("in_band"),
                    F.col("p_date").between(F.lit(RANGE_CFG.start_date).cast("date"),
                                            F.lit(RANGE_CFG.end_date).cast("date")).alias("in_window"))


@probe("fn_round_decimal")
def fn_round_decimal(spark, sf):
    s = facts.rsvp_summary(chain(spark, sf).f_rsvps)
    return out(s.select("event_id", X.rate_pct("accepted_rsvps", "total_rsvps").alias("accepted_share")))


@probe("fn_week_bucket")
def fn_week_bucket(spark, sf):
    w = chain(spark, sf).wide
    m = chain(spark, sf).d_membership.select(F.col("membership_id").alias("__m"), "joined_at")
    j = w.join(m, F.col("membership_id") == F.col("__m"), "left")
    return out(j.select("event_rsvp_id", X.week_start("joined_at").alias("joined_week"),
                        X.week_start("responded_at").alias("responded_week")))


# --------------------------------------------------------------------------
# 2.11 composite jobs
# --------------------------------------------------------------------------
@probe("job_raw_load")
def job_raw_load(spark, sf):
    c = chain(spark, sf)
    csv, table = c.scratch("events-src"), c.scratch("raw-events-table")
    files.write_csv(c.raw("events", p_date=False), csv)
    raw.job_raw_load(spark, csv, "events", table)
    return out(spark.read.parquet(table))


@probe("job_geo_load")
def job_geo_load(spark, sf):
    c = chain(spark, sf)
    csv, table = c.scratch("geo-src"), c.scratch("d-geo")
    files.write_csv(c.geo.withColumnRenamed("country_code", "countryCode"), csv)
    raw.job_geo_load(spark, csv, table)
    return out(spark.read.parquet(table))


@probe("cln_teams")
def cln_teams(spark, sf):
    return out(chain(spark, sf).clean_teams)


@probe("cln_membership")
def cln_membership(spark, sf):
    return out(chain(spark, sf).clean_membership)


@probe("cln_events")
def cln_events(spark, sf):
    return out(chain(spark, sf).clean_events)


@probe("cln_event_rsvps")
def cln_event_rsvps(spark, sf):
    return out(chain(spark, sf).clean_rsvps)


@probe("dq_flags")
def dq_flags(spark, sf):
    return chain(spark, sf).clean_rsvps.select("event_rsvp_id", "is_valid_event_id", "is_valid_membership_id",
                                               "is_valid_rsvp", "is_valid_record")


@probe("dq_error_text")
def dq_error_text(spark, sf):
    return chain(spark, sf).clean_rsvps.select("event_rsvp_id", "validation_error")


@probe("dim_teams")
def dim_teams(spark, sf):
    return out(chain(spark, sf).d_teams)


@probe("dim_membership")
def dim_membership(spark, sf):
    return out(chain(spark, sf).d_membership)


@probe("dim_events")
def dim_events(spark, sf):
    return out(chain(spark, sf).d_events)


@probe("dim_geo")
def dim_geo(spark, sf):
    c = chain(spark, sf)
    path = c.scratch("d-geo-looker")
    sinks.write_full(c.geo, path)
    view = f"v_d_geo_looker_{uuid.uuid4().hex[:8]}"
    sinks.create_view(spark, view, path)
    return out(spark.table(view))


@probe("fct_event_rsvps")
def fct_event_rsvps(spark, sf):
    return out(chain(spark, sf).f_rsvps)


@probe("fct_events_enriched")
def fct_events_enriched(spark, sf):
    return out(chain(spark, sf).enriched)


@probe("fct_event_rsvps_wide")
def fct_event_rsvps_wide(spark, sf):
    return out(chain(spark, sf).wide)


# --------------------------------------------------------------------------
# 2.12 quality checks and metrics
# --------------------------------------------------------------------------
@probe("dq_count_parity")
def dq_count_parity(spark, sf):
    c = chain(spark, sf)
    parts = []
    for entity, (schema, _, _, _) in schemas.ENTITIES.items():
        csv, table = c.scratch(f"{entity}-csv"), c.scratch(f"{entity}-raw")
        files.write_csv(c.raw(entity, p_date=False), csv)
        raw.job_raw_load(spark, csv, entity, table)
        parts.append(quality.count_parity(spark.read.option("header", True).csv(csv),
                                          spark.read.parquet(table), entity))
    return reduce(lambda a, b: a.unionByName(b), parts)


@cache
def _published(app: str, sf: str) -> batch.Warehouse:
    """One run of the whole chain into stored tables and views, shared by the checks that read those."""
    spark = SparkSession.getActiveSession()
    src = {e: adapter.raw(spark, sf, e, p_date=False) for e in schemas.ENTITIES}
    return batch.run_batch(spark, PROBE_CFG, src, adapter.geo_boxes(spark, sf), root=scratch_path(spark, "published"))


def published(spark: SparkSession, sf: str) -> batch.Warehouse:
    wh = _published(prepare(spark).sparkContext.applicationId, sf)
    batch.publish_views(wh)
    return wh


@probe("inc_chain")
def inc_chain(spark, sf):
    """The enriched fact of a base load, two daily runs, one for the days after them and revalidation:
    what one full load gives. Teams, members and events of the later days are late parents of the earlier ones."""
    src = {e: adapter.raw(spark, sf, e, p_date=False) for e in schemas.ENTITIES}
    root, geo = scratch_path(spark, "inc-chain"), adapter.geo_boxes(spark, sf)
    batch.run_batch(spark, PROBE_CFG.with_(end_date=CHAIN_BASE_END), src, geo, root=root)
    rest = PROBE_CFG.with_(start_date=CHAIN_REST, full_load=False)
    for cfg in (*map(JobConfig.for_day, CHAIN_DAYS), rest):
        batch.run_batch(spark, cfg, src, geo, root=root)
    wh = batch.Warehouse(spark, rest, root)
    revalidate_clean(wh)
    return out(wh.read("analytics", "f_events_enriched").drop("etl_created_date", "etl_updated_date"))


@probe("inc_retraction")
def inc_retraction(spark, sf):
    """Keys and states of all published tables after a base load, a day on which parents are withdrawn, one on which
    half of them are valid again, and the days after: what one full load over all deliveries gives."""
    src = adapter.with_withdrawals(prepare(spark), sf)
    root, geo = scratch_path(spark, "inc-retraction"), adapter.geo_boxes(spark, sf)
    batch.run_batch(spark, PROBE_CFG.with_(end_date=CHAIN_BASE_END), src, geo, root=root)
    rest = PROBE_CFG.with_(start_date=CHAIN_REST, full_load=False)
    for cfg in (*map(JobConfig.for_day, CHAIN_DAYS), rest):
        wh = batch.run_batch(spark, cfg, src, geo, root=root)

    def rows(table: str, key: str, *state: str) -> DataFrame:
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in state]
        return wh.read("analytics", table).select(F.lit(table).alias("table_name"), F.col(key).alias("row_key"),
                                                  F.concat_ws("|", *texts).alias("state"))
    return reduce(DataFrame.unionByName, [
        rows("d_teams", "team_id", "country_code", "team_activity"), rows("d_membership", "membership_id", "team_id"),
        rows("d_events", "event_id", "team_id"),
        rows("f_events_rsvps", "event_rsvp_id", "event_id", "membership_id", "rsvp_status", "is_latest_response"),
        rows("f_events_enriched", "event_id", "event_date", "region", "total_rsvps", "accepted_rsvps")])


@probe("inc_stream")
def inc_stream(spark, sf):
    """The enriched fact after three landings of CSV files, each taken up by the same checkpointed stream: a base
    load, one day, and the days after it. What one full load gives."""
    prepare(spark)
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "inc-stream")
    stream = DailyStream(spark, landing, scratch_path(spark, "stream-state"), PROBE_CFG, adapter.geo_boxes(spark, sf), root)
    day = F.coalesce("p_date", F.lit(CHAIN_BASE_END).cast("date"))
    parts = {"base": day <= F.lit(CHAIN_BASE_END).cast("date"), "day": day == F.lit(CHAIN_DAYS[0]).cast("date"),
             "rest": day > F.lit(CHAIN_DAYS[0]).cast("date")}
    for name, rows in parts.items():
        for e in schemas.ENTITIES:
            files.write_csv(adapter.raw(spark, sf, e).where(rows).drop("p_date"), f"{landing}/{e}/{name}")
        stream.run()
    return out(batch.Warehouse(spark, PROBE_CFG, root).read("analytics", "f_events_enriched")
               .drop("etl_created_date", "etl_updated_date"))


@probe("agg_periods_from_days")
def agg_periods_from_days(spark, sf):
    """Weekly and monthly rollups from the stored days only, which two loads brought together; the second one
    numbers new teams and replaces the days it touches."""
    c = chain(spark, sf)
    wh = batch.Warehouse(c.spark, PROBE_CFG, scratch_path(spark, "periods"))
    enriched = c.enriched
    days = [r[0] for r in enriched.select("event_date").distinct().collect()]  # one row a day
    half = sorted(d for d in days if d is not None)[len(days) // 2:]
    day_state.refresh(wh, enriched.where(~catalog.on_dates(half, "event_date")), None)
    day_state.refresh(wh, enriched, [*half, *([None] if None in days else [])])
    return out(day_state.weekly_monthly(wh.read("aggregates", day_state.STATE)))


@probe("dq_layer_parity")
def dq_layer_parity(spark, sf):
    """Counts of stored layers: every table is written once and counted as it is."""
    wh = published(spark, sf)
    t = {n: wh.read("clean", f"clean_{n}") for n in ("teams", "membership", "events", "events_rsvps")}
    return quality.count_union([
        ("raw_events_rsvps", wh.read("raw", "raw_events_rsvps")), ("clean_events_rsvps", t["events_rsvps"]),
        ("clean_teams_valid", clean.valid_rows(t["teams"])), ("d_teams", wh.read("analytics", "d_teams")),
        ("clean_membership_valid", clean.valid_rows(t["membership"])), ("d_membership", wh.read("analytics", "d_membership")),
        ("clean_events_valid", clean.valid_rows(t["events"])), ("d_events", wh.read("analytics", "d_events")),
        ("f_events_enriched", wh.read("analytics", "f_events_enriched")),
    ])


def published_views(wh: batch.Warehouse) -> dict[str, str]:
    return {n: wh.view_name(n) for n in quality.PUBLISHED}


@probe("dq_queryable")
def dq_queryable(spark, sf):
    views = published_views(published(spark, sf)) | {"v_not_there": f"v_not_there_{uuid.uuid4().hex[:8]}"}
    return quality.queryable(spark, views)


@probe("dq_required_columns")
def dq_required_columns(spark, sf):
    views = published_views(published(spark, sf))
    return reduce(DataFrame.unionByName, [quality.required_columns(spark.table(v), n, quality.PUBLISHED[n][0])
                                          for n, v in views.items()])


@probe("dq_not_null")
def dq_not_null(spark, sf):
    views = published_views(published(spark, sf))
    checks = {"v_f_events_rsvps": ["event_rsvp_id", "event_start", "event_end", "etl_created_date", "p_date"],
              "v_d_teams": ["team_id"]}
    return reduce(DataFrame.unionByName, [quality.not_null(spark.table(views[n]), n, cols) for n, cols in checks.items()])


@probe("dq_accepted_values")
def dq_accepted_values(spark, sf):
    c = chain(spark, sf)
    allowed = list(PROBE_CFG.valid_rsvp_statuses)
    return (quality.accepted_values(c.f_rsvps, "f_events_rsvps", "rsvp_status", allowed)
            .unionByName(quality.accepted_values(c.raw("event_rsvps"), "raw_events_rsvps", "rsvp_status", allowed)))


@probe("dq_partition_drift")
def dq_partition_drift(spark, sf):
    """Distances of neighbouring days from stored histograms, which a load of all days but some and a daily refresh
    of those brought together."""
    c = chain(spark, sf)
    wh = batch.Warehouse(c.spark, PROBE_CFG, scratch_path(spark, "drift"))
    late = [dt.date.fromisoformat(d) for d in CHAIN_DAYS]
    wh.write(c.clean_rsvps, "clean", "clean_events_rsvps", "p_date")
    wh.write(c.clean_events, "clean", "clean_events", "p_date")
    tables = drift.watched(wh)
    drift.refresh(wh, {n: (df.where(~catalog.on_dates(late)), cols) for n, (df, cols) in tables.items()}, None)
    drift.refresh(wh, tables, late)
    return out(drift.day_distances(wh.read("aggregates", drift.STATE)))


@probe("dq_unique_pk")
def dq_unique_pk(spark, sf):
    return quality.unique_pk(chain(spark, sf).raw("event_rsvps"), "raw_events_rsvps", "event_rsvp_id")


@probe("dq_multi_response")
def dq_multi_response(spark, sf):
    return quality.multi_response(chain(spark, sf).clean_rsvps)


@probe("met_daily_active_teams")
def met_daily_active_teams(spark, sf):
    return metrics.met_daily_active_teams(chain(spark, sf).d_events)


@probe("met_rsvp_summary")
def met_rsvp_summary(spark, sf):
    return metrics.met_rsvp_summary(chain(spark, sf).enriched)


@probe("met_attendance_30d")
def met_attendance_30d(spark, sf):
    return out(metrics.met_attendance_30d(chain(spark, sf).f_rsvps, RANGE_CFG.end_date))


@probe("met_new_vs_returning")
def met_new_vs_returning(spark, sf):
    c = chain(spark, sf)
    return metrics.met_new_vs_returning(c.f_rsvps, c.d_membership)


@probe("met_events_per_region")
def met_events_per_region(spark, sf):
    return metrics.met_events_per_region(chain(spark, sf).enriched)


@probe("fct_membership_enriched")
def fct_membership_enriched(spark, sf):
    c = chain(spark, sf)
    return metrics.fct_membership_enriched(c.f_rsvps, c.d_membership)


@probe("agg_weekly_monthly")
def agg_weekly_monthly(spark, sf):
    return out(metrics.agg_weekly_monthly(chain(spark, sf).enriched))


@probe("met_attendance_by_day")
def met_attendance_by_day(spark, sf):
    return out(metrics.attendance_by_day(chain(spark, sf).f_rsvps))


@probe("met_activity_streaks")
def met_activity_streaks(spark, sf):
    return out(metrics.activity_streaks(chain(spark, sf).f_rsvps))


@probe("agg_activity_rollup")
def agg_activity_rollup(spark, sf):
    return out(metrics.activity_rollup(chain(spark, sf).enriched))


@probe("win_status_at_start")
def win_status_at_start(spark, sf):
    c = chain(spark, sf)
    return out(metrics.status_at_start(c.f_rsvps, c.d_events))


@probe("dim_date")
def dim_date(spark, sf):
    c = chain(spark, sf)
    span = metrics.data_date_span((c.raw("events"), "event_start"), (c.raw("event_rsvps"), "responded_at"))
    return metrics.dim_date("lo", "hi", frame=span)


@probe("job_revalidate")
def job_revalidate(spark, sf):
    """Memberships first checked while only teams created before the split day
    were known, then revalidated against all teams: the rows that changed."""
    c = chain(spark, sf)
    early_teams = clean.clean_teams(c.raw("teams").where(F.col("p_date") < F.lit(SPLIT_DAY).cast("date")),
                                    PROBE_CFG)
    old = clean.clean_membership(c.raw("memberships"), early_teams, PROBE_CFG)
    return out(maintenance.revalidate_membership(old, c.raw("memberships"), c.clean_teams, PROBE_CFG))


@probe("job_retention")
def job_retention(spark, sf):
    c = chain(spark, sf)
    return out(maintenance.retention_report(c.raw("event_rsvps"), "raw_events_rsvps", RETENTION_CUTOFF))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(REGISTRY)
