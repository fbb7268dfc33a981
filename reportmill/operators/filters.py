"""Row filters and run gates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportmill.functions import column, month_window, week_start
from reportmill.spec import ReportSpec


def drop_dirty(df: DataFrame, spec: ReportSpec) -> DataFrame:
    """Rows that have a partition: account and date are both present."""
    return df.where(column(spec.account).isNotNull() & column(spec.date).isNotNull())


def in_month_window(
    df: DataFrame, name: str, run_day: Column | dt.date | str | None = None
) -> DataFrame:
    """Rows whose day lies in the month window of ``run_day``, both ends included.

    The bare column is compared, so the bounds reach the scan as pushed filters.
    """
    first, last = month_window(run_day)
    return df.where((column(name) >= first) & (column(name) < F.date_add(last, 1)))


def in_week(
    df: DataFrame, name: str, run_day: Column | dt.date | str | None = None
) -> DataFrame:
    """Rows of the Monday-to-Sunday week around ``run_day``."""
    first = week_start(run_day)
    return df.where((column(name) >= first) & (column(name) < F.date_add(first, 7)))
