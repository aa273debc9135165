"""Row filters. Each returns a DataFrame; chained filters become one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.functions.times import parse_day, year_bounds


def on_walk(rows: DataFrame, walk: str | int, column: str = "walk_id") -> DataFrame:
    return rows.filter(F.col(column) == F.lit(walk))


def on_sensor(rows: DataFrame, sensor: str, column: str = "sensor_type") -> DataFrame:
    return rows.filter(F.col(column) == F.lit(sensor))


def in_year(rows: DataFrame, year: int, column: str = "window_start") -> DataFrame:
    """``year(column) = year``, written as a range of days.

    Spark turns the range into time bounds that reach the Parquet scan; it does
    not do so for ``year()``.
    """
    first, after = year_bounds(year)
    day = F.to_date(column)
    return rows.filter((day >= F.lit(first)) & (day < F.lit(after)))


def on_day(rows: DataFrame, day: str | dt.date, column: str = "window_start") -> DataFrame:
    return rows.filter(F.to_date(column) == F.lit(parse_day(day)))


def complete_rows(rows: DataFrame, *columns: str) -> DataFrame:
    """Drop rows with NULL or NaN in any of the columns."""
    return rows.na.drop(subset=list(columns))


def has_no_data(rows: DataFrame) -> bool:
    return rows.isEmpty()
