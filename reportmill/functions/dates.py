"""Calendar helpers: partition parts, ISO weeks and the reporting windows of a run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reach of the month window, in days before this Monday and after today.
DAYS_BACK = 28
DAYS_AHEAD = 34


def as_date(day: Column | dt.date | str | None = None) -> Column:
    """A date column from a column, a date or ISO text; the current date when not given."""
    if day is None:
        return F.current_date()
    return (day if isinstance(day, Column) else F.lit(day)).cast("date")


def monday_of(day: Column) -> Column:
    return F.date_trunc("week", day).cast("date")


def month_window(day: Column | dt.date | str | None = None) -> tuple[Column, Column]:
    """First and last day of the month window: Monday four weeks back, and day + 34."""
    run_day = as_date(day)
    return F.date_sub(monday_of(run_day), DAYS_BACK), F.date_add(run_day, DAYS_AHEAD)


def week_start(day: Column | dt.date | str | None = None) -> Column:
    return monday_of(as_date(day))


def iso_day(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def date_parts(day: Column, padded: bool = False) -> dict[str, Column]:
    """``year``, ``month`` and ``day``; as integers, or as text with two-digit month and day."""
    parts = {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}
    if not padded:
        return parts
    return {
        name: part.cast("string") if name == "year" else F.lpad(part.cast("string"), 2, "0")
        for name, part in parts.items()
    }
