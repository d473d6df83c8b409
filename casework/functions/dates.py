"""Date helpers. ``as_of`` is the run day; "now" is a moment within that day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_ended(end: Column, as_of: dt.date) -> Column:
    """The (midnight) end date lies after the run day's "now"."""
    return end > F.lit(as_of)


def valid_on(start: Column, end: Column, as_of: dt.date) -> Column:
    """Started on or before the run day and not ended."""
    return (start <= F.lit(as_of)) & not_ended(end, as_of)


def newer_than(day: Column, as_of: dt.date, days: int) -> Column:
    """Rolling window filter: ``day`` lies within the last ``days`` days.

    The bound is a literal, so it reaches partition pruning and the scan.
    """
    return day > F.lit(as_of - dt.timedelta(days=days))


def recent_rows(history: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    """History rows whose insert date lies within the last ``days`` days.

    A row's insert date is its run's day or null, so the same bound on the run
    date, where the table has it, prunes the partitions.
    """
    rows = history.filter(newer_than(F.col("insrt_dt"), as_of, days))
    return rows.filter(newer_than(F.col("run_date"), as_of, days)) if "run_date" in history.columns else rows


def year_month_day(day: Column) -> Column:
    return F.date_format(day, "yyMMdd")


def month_day_year(day: Column) -> Column:
    return F.date_format(day, "MM/dd/yyyy")


def days_between(later: Column, earlier: Column) -> Column:
    """Fractional days from one timestamp to another."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(86_400_000_000.0)
