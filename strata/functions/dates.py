"""Date and time strings.

All functions take and return Columns and stay inside whole-stage codegen.
Times are interpreted in the session time zone, which the catalogue pins to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ts_from_millis(millis: ColumnOrName) -> Column:
    """Epoch milliseconds -> TIMESTAMP (session zone)."""
    return F.timestamp_millis(_c(millis))


def day_str(ts: ColumnOrName) -> Column:
    """Calendar day as ``y-M-d`` without zero padding, e.g. ``2020-8-25``."""
    return F.date_format(_c(ts), "y-M-d")


def hour_str(ts: ColumnOrName) -> Column:
    """Hour of day 0-23 as text, not padded."""
    return F.date_format(_c(ts), "H")


def minute_str(ts: ColumnOrName) -> Column:
    """Minute 0-59 as text, not padded."""
    return F.date_format(_c(ts), "m")


def prev_day(day: ColumnOrName) -> Column:
    """``yyyy-MM-dd`` minus one day, same format.  A malformed day raises (ANSI)."""
    return F.date_format(F.date_sub(F.to_date(_c(day), "yyyy-MM-dd"), 1), "yyyy-MM-dd")


def compact_day(day: ColumnOrName) -> Column:
    """C4: ``yyyy-MM-dd`` -> ``yyyyMMdd`` (the per-day index suffix)."""
    return F.date_format(F.to_date(_c(day), "yyyy-MM-dd"), "yyyyMMdd")


def processing_day() -> Column:
    """today's date as ``yyyyMMdd`` (session zone)."""
    return F.date_format(F.current_date(), "yyyyMMdd")


def hour_of(datetime_text: ColumnOrName) -> Column:
    """Hour 0-23 of a ``yyyy-MM-dd HH:mm:ss`` string (null when unparsable)."""
    return F.hour(F.try_to_timestamp(_c(datetime_text), F.lit("yyyy-MM-dd HH:mm:ss")))


def split_create_time(create_time: ColumnOrName) -> tuple[Column, Column]:
    """Split ``create_time`` on the blank into (date part, first two chars of the time).

    A value without a time part gives nulls instead of an error (SURVEY T2).
    """
    parts = F.split(_c(create_time), " ")
    date_part = F.try_element_at(parts, F.lit(1))
    time_part = F.try_element_at(parts, F.lit(2))
    return date_part, F.substring(time_part, 1, 2)
