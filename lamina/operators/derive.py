"""Derived time, rate and ratio columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions import timing


def add_span_columns(df: DataFrame, start: str, end: str, distance: str, minutes: str, speed: str) -> DataFrame:
    """Duration in minutes and speed in distance units per hour."""
    return df.withColumns(
        {
            minutes: timing.elapsed_minutes(start, end),
            speed: timing.rate_per_hour(distance, start, end),
        }
    )


def add_calendar_columns(df: DataFrame, time: str, prefix: str) -> DataFrame:
    """`<prefix>_date`, `<prefix>_hour`, `day_of_week` (English name) and `is_weekend`."""
    return df.withColumns(
        {
            f"{prefix}_date": F.to_date(time),
            f"{prefix}_hour": F.hour(time),
            "day_of_week": timing.day_name(time),
            "is_weekend": timing.is_weekend(time),
        }
    )


def add_percentage(df: DataFrame, name: str, part: str, whole: str) -> DataFrame:
    return df.withColumn(name, timing.percent_of(part, whole))
