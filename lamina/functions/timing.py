"""Time expressions. Inputs may be `timestamp` or `timestamp_ntz`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_timestamp(name: str) -> Column:
    return F.col(name).cast("timestamp")


def elapsed_seconds(start: str, end: str) -> Column:
    """Whole seconds from start to end, each floored to the second first."""
    return F.unix_seconds(as_timestamp(end)) - F.unix_seconds(as_timestamp(start))


def elapsed_minutes(start: str, end: str) -> Column:
    return elapsed_seconds(start, end) / F.lit(60.0)


def rate_per_hour(amount: str, start: str, end: str) -> Column:
    """amount / hours; null unless time passes."""
    seconds = elapsed_seconds(start, end)
    return F.when(seconds > 0, F.col(amount) / (seconds / F.lit(3600.0)))


def percent_of(part: str, whole: str) -> Column:
    """part / whole * 100; 0.0 where whole is not positive (or null), null where part is null."""
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole) * F.lit(100.0)).otherwise(F.lit(0.0))


def is_weekend(name: str) -> Column:
    """Saturday or Sunday (Spark numbers Sunday 1 and Saturday 7)."""
    return F.dayofweek(name).isin(1, 7)


def day_name(name: str) -> Column:
    return F.date_format(name, "EEEE")


def in_ingest_window(name: str, year: str, month: str, grace_days: int = 1) -> Column:
    """True where the time lies in the ingest month, widened by whole days on each side.

    Stated as a range on the bare column: once year and month are fixed by a partition
    filter both ends fold to literals and reach the parquet scan.
    """
    first = F.make_date(year, month, F.lit(1))
    start = F.date_sub(first, grace_days).cast("timestamp")
    end = F.date_add(F.add_months(first, 1), grace_days).cast("timestamp")
    return (as_timestamp(name) >= start) & (as_timestamp(name) < end)
