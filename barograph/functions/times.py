"""Epoch seconds, event time and calendar bounds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last second of the years 1 to 9999, UTC.
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799


def whole_seconds(epoch: Column) -> Column:
    """Epoch seconds cut toward zero; NaN and out-of-range values become NULL."""
    seconds = epoch.try_cast("bigint")
    return F.when(seconds.between(FIRST_SECOND, LAST_SECOND), seconds)


def epoch_text(epoch: Column) -> Column:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss`` in the session zone."""
    return F.from_unixtime(whole_seconds(epoch))


def event_time(epoch: Column, precision: str = "seconds") -> Column:
    """Epoch seconds as a timestamp.

    Second precision equals reading :func:`epoch_text` back with
    ``to_timestamp``, but without the string, so a DST overlap in the session
    zone cannot merge two instants.
    """
    if precision == "seconds":
        return F.timestamp_seconds(whole_seconds(epoch))
    if precision == "micros":
        in_range = whole_seconds(epoch).isNotNull()
        return F.when(in_range, F.timestamp_micros(F.round(epoch * 1e6).try_cast("bigint")))
    raise ValueError(f"precision must be 'seconds' or 'micros', not {precision!r}")


def epoch_seconds(moment: Column) -> Column:
    """A timestamp as fractional epoch seconds."""
    return F.unix_micros(moment.cast("timestamp")) / F.lit(1e6)


def parse_day(day: str | dt.date) -> dt.date:
    """A calendar day, checked here so that a bad one fails before any job runs."""
    if isinstance(day, dt.datetime):
        return day.date()
    if isinstance(day, dt.date):
        return day
    try:
        return dt.datetime.strptime(day, "%Y-%m-%d").date()
    except ValueError as error:
        raise ValueError(f"not a calendar day (yyyy-mm-dd): {day!r}") from error


def year_bounds(year: int) -> tuple[dt.date, dt.date]:
    """First day of the year and of the next one."""
    if not 1 <= int(year) <= 9998:
        raise ValueError(f"year out of range: {year!r}")
    return dt.date(int(year), 1, 1), dt.date(int(year) + 1, 1, 1)
