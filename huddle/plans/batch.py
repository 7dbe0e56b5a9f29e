"""A whole run in dependency order: raw -> clean -> dims -> facts -> views.

Stages hand over only through stored tables, as the layers do in production.
``Warehouse`` names the tables: catalog tables by default, or path tables under
a shared root (``root``), which needs no metastore.
"""

from __future__ import annotations

from concurrent.futures import Future
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from huddle import schemas
from huddle.config import JobConfig
from huddle.operators import sinks
from huddle.plans import clean, dims, facts
from huddle.plans.raw import raw_frame
from huddle.session import prepare, together
from huddle.sources.catalog import window_filter

CLEAN_TABLES = {"teams": "clean_teams", "memberships": "clean_membership", "events": "clean_events",
                "event_rsvps": "clean_events_rsvps"}


@dataclass
class Warehouse:
    spark: SparkSession
    cfg: JobConfig
    root: str | None = None
    # what an incremental run touched, for the stages after it
    touched: dict = field(default_factory=dict)
    _frames: dict = field(default_factory=dict, repr=False)
    # of the tables that this run has written, which need not be inferred from their files again
    _written: dict = field(default_factory=dict, repr=False)
    # change sets looked up (retraction.noted), by target
    found_changes: dict = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        if not self.root:
            for db in {self.cfg.raw_db, self.cfg.clean_db, self.cfg.analytics_db, self.cfg.aggregates_db}:
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")

    def target(self, layer: str, name: str) -> str:
        if self.root:
            db = self.cfg.table(layer, name).split(".")[0]
            return f"{self.root.rstrip('/')}/{db}/{name}"
        return self.cfg.table(layer, name)

    def read(self, layer: str, name: str) -> DataFrame:
        """The stored table; one file listing per table until it is written again.

        Writes made outside ``write`` (e.g. a direct ``sinks.upsert``) must be
        followed by ``forget(target)``.
        """
        t = self.target(layer, name)
        frame = self._frames.get(t)
        if frame is None:
            frame = self._frames[t] = sinks.read_target(self.spark, t, self.cfg.table_format, schemas.STORED.get(name),
                                                        self._written.get(t))
        return frame

    def exists(self, layer: str, name: str) -> bool:
        return sinks.target_exists(self.spark, self.target(layer, name), self.cfg.table_format)

    def write(self, df: DataFrame, layer: str, name: str, partition_by: str | None = None,
              dynamic: bool = False, rebalance: bool = True) -> None:
        t = self.target(layer, name)
        sinks.write_table(df, t, partition_by=partition_by, dynamic=dynamic, fmt=self.cfg.table_format, rebalance=rebalance)
        self._written[t] = df.schema
        self.forget(t)

    def forget(self, target: str) -> None:
        self._frames.pop(target, None)
        self.found_changes.pop(target, None)
        if not sinks.is_path(target):
            self.spark.catalog.refreshTable(target)

    def view_name(self, name: str) -> str:
        """A published view: in the analytics database, or a temporary view over path tables."""
        return name if self.root else self.cfg.table("analytics", name)

    def view(self, name: str, layer: str, table: str) -> None:
        t = self.target(layer, table)
        if self.root:
            self.read(layer, table).createOrReplaceTempView(name)  # a declared schema where no file is yet
        else:
            sinks.create_view(self.spark, self.view_name(name), t, self.cfg.table_format)

    def view_sql(self, name: str, sql: str) -> None:
        kind = "TEMPORARY VIEW" if self.root else "VIEW"
        self.spark.sql(f"CREATE OR REPLACE {kind} {self.view_name(name)} AS {sql}")


def load_raw(wh: Warehouse, sources: dict[str, DataFrame], geo: DataFrame | None = None) -> None:
    """Source frames (declared columns, no p_date) -> p_date-partitioned raw
    tables. Incremental runs read only the window from the source and replace
    only its partitions."""
    incremental = not wh.cfg.full_load
    # every source is gated before any is written
    frames = {schemas.ENTITIES[entity][3]: raw_frame(df, entity) for entity, df in sources.items()}

    def load(table: str) -> None:
        out = window_filter(frames[table], wh.cfg) if incremental else frames[table]
        # all of a source is not moved just to be stored: clean shuffles it by key anyway
        wh.write(out, "raw", table, "p_date", dynamic=incremental, rebalance=incremental)

    def load_boxes() -> None:
        if geo is None:
            return
        if incremental and wh.exists("analytics", "d_geo_looker"):
            old = wh.read("analytics", "d_geo_looker").select(*geo.columns)
            differs = together(wh.spark, lambda: not old.exceptAll(geo).isEmpty(), lambda: not geo.exceptAll(old).isEmpty())
            wh.touched["boxes"] = any(differs)
            if not wh.touched["boxes"]:
                return
        wh.write(geo, "analytics", "d_geo_looker")

    together(wh.spark, *[partial(load, t) for t in frames], load_boxes)


def _raw(wh: Warehouse, entity: str) -> DataFrame:
    return wh.read("raw", schemas.ENTITIES[entity][3])


def run_clean(wh: Warehouse) -> None:
    """Each clean table is written before the next one validates against it.
    FK probes read the whole stored clean table, not just the window."""
    from huddle.operators.locations import Locations
    from huddle.streaming.incremental import merge_keyed_day, merge_rsvp_day, rsvp_locations
    from huddle.streaming.retraction import follow

    cfg, incr = wh.cfg, not wh.cfg.full_load

    def run(entity: str, key: str, prepare, validate) -> None:
        table = CLEAN_TABLES[entity]
        if incr and wh.exists("clean", table):
            merge_keyed_day(wh, table, key, prepare(_raw(wh, entity), cfg), validate)
            if table != "clean_teams":
                follow(wh, table)
        else:
            wh.write(validate(prepare(_raw(wh, entity), cfg)), "clean", table, "p_date", dynamic=incr)
            Locations(wh, table, key).rebuild(wh.read("clean", table))

    # memberships and events are prepared beside the teams, and validated once those are stored
    stored = Future()

    def teams() -> None:
        try:
            run("teams", "team_id", clean.prepare_teams, lambda d: clean.validate_teams(d, cfg))
            stored.set_result(None)
        except BaseException as e:  # raised by whoever waits, too
            stored.set_exception(e)
            raise

    def valid_teams() -> DataFrame:
        stored.result()
        return wh.read("clean", "clean_teams")

    together(wh.spark, teams,
             lambda: run("memberships", "membership_id", clean.prepare_membership, lambda d: clean.validate_membership(d, valid_teams())),
             lambda: run("events", "event_id", clean.prepare_events, lambda d: clean.validate_events(d, valid_teams())))
    if incr and wh.exists("clean", "clean_events_rsvps"):
        merge_rsvp_day(wh)
        follow(wh, "clean_events_rsvps")
    else:
        rsvps = clean.clean_event_rsvps(_raw(wh, "event_rsvps"), wh.read("clean", "clean_membership"),
                                        wh.read("clean", "clean_events"), cfg)
        wh.write(rsvps, "clean", "clean_events_rsvps", "p_date", dynamic=incr)
        rows = wh.read("clean", "clean_events_rsvps")
        together(wh.spark, *[partial(places.rebuild, rows) for places in rsvp_locations(wh)])


def run_dims(wh: Warehouse) -> None:
    from huddle.streaming import retraction

    def load(dim: str, src: str, key: str, cols: list[str]) -> None:
        gone = None
        if wh.cfg.full_load:
            frame = dims.dim_frame(wh.read("clean", src), cols, wh.cfg)
        else:
            # a changed key's row may sit in another partition than the window's
            changes = retraction.noted(wh, src)
            dates = [*(wh.touched.get(src) or []), *([] if changes is None else [r[0] for r in changes.select("p_date").distinct().collect()])]
            frame = dims.dim_frame(wh.read("clean", src), cols, wh.cfg, extra_dates=dates)
            frame, gone = retraction.dimension_changes(wh, src, key, frame)
        dims.load_dim(wh.spark, frame, wh.target("analytics", dim), key, wh.cfg, gone)
        wh.forget(wh.target("analytics", dim))

    together(wh.spark, *[partial(load, dim, *spec) for dim, spec in dims.DIMS.items()])


def geo_boxes(wh: Warehouse) -> DataFrame:
    """The stored box table, or no boxes at all (every region NULL)."""
    if wh.exists("analytics", "d_geo_looker"):
        return wh.read("analytics", "d_geo_looker")
    return wh.spark.createDataFrame([], schemas.GEO_BOXES)


def run_facts(wh: Warehouse) -> None:
    cfg = wh.cfg
    if cfg.full_load or not wh.exists("analytics", "f_events_rsvps"):
        f = facts.fct_event_rsvps(wh.read("clean", "clean_events_rsvps"), cfg)
        # a narrow copy of the clean table, whose files hold a day each: a task has few days
        wh.write(f, "analytics", "f_events_rsvps", "p_date", rebalance=False)
        e = facts.fct_events_enriched(wh.read("analytics", "d_events"), wh.read("analytics", "d_teams"),
                                      geo_boxes(wh), wh.read("analytics", "f_events_rsvps"), cfg)
        wh.write(e, "analytics", "f_events_enriched", "event_date")
    else:
        from huddle.streaming.incremental import refresh_facts
        refresh_facts(wh)


def publish_views(wh: Warehouse) -> None:
    for dim in dims.DIMS:
        wh.view(f"v_{dim}", "analytics", dim)
    if wh.exists("analytics", "d_geo_looker"):
        wh.view("v_d_geo_looker", "analytics", "d_geo_looker")
    wh.view("v_f_events_enriched", "analytics", "f_events_enriched")
    # the published RSVP view carries the event's, team's and member's columns
    if wh.root:
        wh.view("__f_events_rsvps", "analytics", "f_events_rsvps")
    rsvps = "__f_events_rsvps" if wh.root else wh.target("analytics", "f_events_rsvps")
    wh.view_sql("v_f_events_rsvps", facts.wide_view_sql(
        rsvps, wh.view_name("v_d_events"), wh.view_name("v_d_teams"), wh.view_name("v_d_membership")))


def run_aggregates(wh: Warehouse) -> None:
    """The aggregates layer: period tables over the published facts, and the calendar.

    Teams per day, week and month come from the stored days, of which a daily run replaces those it touched.
    """
    from huddle.plans import day_state, metrics
    enriched, f = wh.read("analytics", "f_events_enriched"), wh.read("analytics", "f_events_rsvps")
    members, events = wh.read("analytics", "d_membership"), wh.read("analytics", "d_events")

    def write(tables: dict[str, DataFrame]) -> None:  # one row per day, week, region: small results, one file each
        together(wh.spark, *[partial(wh.write, df.coalesce(1), "aggregates", name) for name, df in tables.items()])

    def from_days() -> None:
        day_state.refresh(wh, enriched, None if wh.cfg.full_load else wh.touched.get("event_days"))
        days = wh.read("aggregates", day_state.STATE)
        write({"weekly_monthly": day_state.weekly_monthly(days), "daily_active_teams": day_state.daily_active_teams(days)})

    together(wh.spark, from_days, lambda: write({
        "membership_enriched": metrics.fct_membership_enriched(f, members),
        "new_vs_returning": metrics.met_new_vs_returning(f, members),
        "events_per_region": metrics.met_events_per_region(enriched),
        "dim_date": metrics.dim_date("lo", "hi", frame=metrics.data_date_span((events, "event_start"), (f, "responded_at"))),
    }))


def check_published(wh: Warehouse) -> None:
    """Fail the run when the published views break their contract."""
    from huddle.plans import quality
    report = quality.published_report(wh.spark, {n: wh.view_name(n) for n in quality.PUBLISHED}, list(wh.cfg.valid_rsvp_statuses))
    quality.assert_zero(report, "findings")


def run_batch(spark: SparkSession, cfg: JobConfig, sources: dict[str, DataFrame] | None = None,
              geo: DataFrame | None = None, root: str | None = None) -> Warehouse:
    """One run: load raw (when sources are given), then clean, dims, facts."""
    from huddle.streaming.retraction import settle

    wh = Warehouse(prepare(spark), cfg, root)
    if sources is not None:
        load_raw(wh, sources, geo)
    run_clean(wh)
    run_dims(wh)
    run_facts(wh)
    settle(wh)
    publish_views(wh)
    steps = [run_aggregates, check_published] if cfg.quality_gate else [run_aggregates]
    together(spark, *[partial(step, wh) for step in steps])
    if cfg.drift_limit is not None:
        from huddle.plans.drift import check_run
        check_run(wh)
    return wh
