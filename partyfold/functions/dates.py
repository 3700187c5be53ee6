"""Date pieces. Every date comes in as a value; nothing here reads a clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _format(day: Column, pattern: str) -> Column:
    # By way of the date, so that no clock change in the session's zone can move it.
    return F.date_format(day.cast("date"), pattern)


def date_stamp(day: Column) -> Column:
    """The day as `yyyyMMdd`."""
    return _format(day, "yyyyMMdd")


def day_of_month(day: Column) -> Column:
    """Day of the month as two-digit text."""
    return _format(day, "dd")


def is_day_of_month(day: Column, setting: str) -> Column:
    """Whether the day equals a two-digit setting; `'7'` never equals `'07'`."""
    return day_of_month(day) == setting
