"""Timestamps, calendar fields and day differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_timestamp(text: str | Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Text to timestamp; text that does not parse gives NULL, also in ANSI mode."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text, F.lit(fmt))


def days_between(start: Column, end: Column) -> Column:
    """Whole calendar days; the time of day does not count."""
    return F.datediff(end, start)


def month_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def monday_first(day_of_week: Column) -> Column:
    """1 = Sunday ... 7 = Saturday becomes 0 = Monday ... 6 = Sunday."""
    return F.pmod(day_of_week + 5, F.lit(7))


def with_calendar(df: DataFrame, ts: str, prefix: str = "purchase") -> DataFrame:
    at = F.col(ts)
    return df.withColumns(
        {
            f"{prefix}_hour": F.hour(at),
            f"{prefix}_dayofweek": F.dayofweek(at),
            f"{prefix}_month": F.month(at),
            f"{prefix}_year": F.year(at),
            f"{prefix}_quarter": F.quarter(at),
            f"{prefix}_year_month": month_of(at),
        }
    )
