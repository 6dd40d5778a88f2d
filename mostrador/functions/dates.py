"""Calendar helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

Day = dt.date | str


def as_date(value: Day) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def month_of(value: Column | str) -> Column:
    """First day of the calendar month, as a DATE."""
    return F.trunc(F.to_date(value), "MM").cast("date")


def within(df: DataFrame, when: str, start: Day, end: Day, month: str | None = None) -> DataFrame:
    """Rows whose calendar day lies in ``[start, end]``.

    The bounds are literals, so they reach the scan as range filters. ``month`` names the month
    partition column of a stored fact; it is used when the frame has it, to skip whole folders.
    """
    first, last = as_date(start), as_date(end)
    rows = df.where(F.to_date(F.col(when)).between(F.lit(first), F.lit(last)))
    if month and month in df.columns:
        rows = rows.where(F.col(month).between(F.lit(first.replace(day=1)), F.lit(last.replace(day=1))))
    return rows
