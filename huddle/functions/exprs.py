"""Scalar column expressions used across the layers; all JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from huddle.config import RSVP_LABEL_OTHER, RSVP_LABELS


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_ts(c: str | Column) -> Column:
    """TIMESTAMP view of a timestamp column (TIMESTAMP_NTZ is cast in the session zone)."""
    return col(c).cast("timestamp")


def rsvp_label(status: str | Column = "rsvp_status") -> Column:
    """The label of a status; anything that has none, NULL included, is 'n/a'."""
    labels = F.create_map(*[F.lit(x) for pair in RSVP_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, col(status)), F.lit(RSVP_LABEL_OTHER))


def has_location(lat: str | Column = "latitude", lng: str | Column = "longitude") -> Column:
    return col(lat).isNotNull() & col(lng).isNotNull()


def valid_timestamps(start: str | Column = "event_start", end: str | Column = "event_end") -> Column:
    """start <= end (equal is valid); NULL when either side is NULL."""
    return col(start) <= col(end)


def duration_minutes(start: str | Column = "event_start", end: str | Column = "event_end") -> Column:
    """Whole epoch seconds of end minus those of start, over 60, as double.

    Each side is floored to the second before subtracting; may be negative.
    """
    return (as_ts(end).cast("long") - as_ts(start).cast("long")) / F.lit(60)


def count_when(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END)."""
    return F.count(F.when(cond, F.lit(1)))


def rate_pct(numer: str | Column, denom: str | Column) -> Column:
    """ROUND(CASE WHEN d > 0 THEN 100.0 * n / d ELSE 0 END, 2) in decimal arithmetic
    (decimal(27,2) for bigint counts), 0.00 when the denominator is 0 or NULL."""
    n, d = col(numer), col(denom)
    hundred = F.lit(100.0).cast("decimal(4,1)")
    return F.round(F.when(d > 0, hundred * n / d).otherwise(F.lit(0)), 2)


def week_start(c: str | Column) -> Column:
    """Monday of the ISO week, as a date (keeps the year, unlike week numbers)."""
    return F.to_date(F.date_trunc("week", as_ts(c)))


def month_start(c: str | Column) -> Column:
    return F.to_date(F.date_trunc("month", as_ts(c)))


def to_date(c: str | Column) -> Column:
    return F.to_date(as_ts(c))
