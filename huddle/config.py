"""Job parameters carried through every layer."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# These must equal the source system's rules for identical
# results (allowed codes, status enum, labels and error texts).
# ---------------------------------------------------------------------------
VALID_COUNTRY_CODES = ("NOR", "GBR", "USA", "DEU")
VALID_RSVP_STATUSES = (0, 1, 2)
RSVP_LABELS = {0: "unanswered", 1: "accepted", 2: "declined"}
RSVP_LABEL_OTHER = "n/a"
MSG_COUNTRY = "Invalid country_code"
MSG_FK_TEAM = "Invalid FK team_id"
MSG_TIMESTAMPS = "Invalid Timestamps"
MSG_FK_EVENT = "Invalid FK event_id"
MSG_FK_MEMBERSHIP = "Invalid FK membership_id"
MSG_RSVP_STATUS = "Invalid rsvp status"
ERROR_SEPARATOR = ", "
# Default backfill window of the source pipeline.
DEFAULT_START = "2024-01-01"
DEFAULT_END = "2025-03-30"


@dataclass(frozen=True)
class JobConfig:
    """Everything a run needs; one frozen value per run.

    ``start_date``/``end_date`` are inclusive ISO dates applied to ``p_date``.
    ``run_ts`` is the single audit timestamp of the run (``None`` means
    ``current_timestamp()`` at execution), so reruns can be compared.
    """

    start_date: str = DEFAULT_START
    end_date: str = DEFAULT_END
    full_load: bool = True
    run_ts: dt.datetime | None = None
    table_format: str = "parquet"
    raw_db: str = "huddle_raw"
    clean_db: str = "huddle_clean"
    analytics_db: str = "huddle_analytics"
    aggregates_db: str = "huddle_aggregates"
    valid_country_codes: tuple[str, ...] = VALID_COUNTRY_CODES
    valid_rsvp_statuses: tuple[int, ...] = VALID_RSVP_STATUSES
    # Undated RSVPs (NULL responded_at -> NULL p_date) never pass the window
    # filter; set True to keep them (they still are not in any date partition).
    include_undated: bool = False
    # "all": latest flag over every answer (source behaviour);
    # "valid": only answers whose record is valid compete.
    latest_among: str = "all"
    # "state": alphabetically first matching box; "smallest_area": tightest box.
    region_tie: str = "state"
    # Check the published tables at the end of a run and fail it on a finding.
    quality_gate: bool = True
    # Fail a run when a day's values lie further from the day before than this (0 to 1) plus chance; None: not checked.
    drift_limit: float | None = None

    def with_(self, **kw) -> "JobConfig":
        return replace(self, **kw)

    @staticmethod
    def for_day(day: str | dt.date, **kw) -> "JobConfig":
        """Incremental config for a single day (the daily cadence)."""
        d = day if isinstance(day, str) else day.isoformat()
        return JobConfig(start_date=d, end_date=d, full_load=False, **kw)

    @staticmethod
    def yesterday(today: dt.date | None = None, **kw) -> "JobConfig":
        today = today or dt.date.today()
        return JobConfig.for_day(today - dt.timedelta(days=1), **kw)

    def table(self, layer: str, name: str) -> str:
        db = {"raw": self.raw_db, "clean": self.clean_db,
              "analytics": self.analytics_db, "aggregates": self.aggregates_db}[layer]
        return f"{db}.{name}"
