"""Epoch conversion, calendar fields and date parsing (session zone is UTC)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

WEB_LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"


def from_epoch_millis(ms: Column) -> Column:
    """Timestamp with the milliseconds kept."""
    return F.timestamp_millis(ms)


def from_epoch_millis_whole_seconds(ms: Column) -> Column:
    """Timestamp cut to the second, as a warehouse integer division gives it."""
    return F.timestamp_seconds(F.call_function("div", ms, F.lit(1000)))


def day_of_week(ts: Column, convention: str = "sunday1") -> Column:
    """Day number in one of the three conventions in use.

    ``sunday1`` counts Sunday as 1, ``sunday0`` Sunday as 0, ``monday0`` Monday as 0.
    """
    if convention == "sunday1":
        return F.dayofweek(ts)
    if convention == "sunday0":
        return F.dayofweek(ts) - 1
    if convention == "monday0":
        return F.weekday(ts)
    raise ValueError(f"unknown day-of-week convention: {convention}")


def calendar_fields(ts: Column, convention: str = "sunday1") -> dict[str, Column]:
    """The six derived columns of a time dimension."""
    return {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "week": F.weekofyear(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "weekday": day_of_week(ts, convention),
    }


def parse_time(text: Column, fmt: str | None = None) -> Column:
    """Timestamp from text, NULL where the text is not one."""
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)


def parse_web_log_time(text: Column) -> Column:
    """Timestamp from the access-log form, offset applied."""
    return parse_time(text, WEB_LOG_TIME_FORMAT)


def in_year(ts: Column, year: int) -> Column:
    """Year filter as a half-open range, so that it reaches the file scan."""
    return (ts >= F.lit(date(year, 1, 1))) & (ts < F.lit(date(year + 1, 1, 1)))
