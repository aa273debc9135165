"""Reads over windows and the cache: diagnostics, newest rows, chart series."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.operators.filters import complete_rows, on_day
from barograph.schema import GROUP_KEYS


def time_range(rows: DataFrame, column: str = "window_start") -> DataFrame:
    """Earliest and latest time and the number of rows, in one row."""
    return rows.select(
        F.min(column).alias(f"min_{column}"),
        F.max(column).alias(f"max_{column}"),
        F.count("*").alias("row_count"),
    )


def rows_per_day(rows: DataFrame, column: str = "window_start") -> DataFrame:
    return rows.groupBy(F.to_date(column).alias("date")).count().orderBy("date")


def by_start(rows: DataFrame, column: str = "window_start") -> DataFrame:
    """Oldest first, rows without a time at the front."""
    return rows.orderBy(F.col(column).asc_nulls_first())


def newest(
    rows: DataFrame, n: int = 20, column: str = "windowStart", ties: tuple[str, ...] = ()
) -> DataFrame:
    """The n newest rows, newest first: a top-k per task, then one over those.

    ``ties`` orders rows of the same time, so that the choice does not vary.
    """
    return rows.orderBy(F.col(column).desc_nulls_last(), *ties).limit(n)


def band_series(
    stats: DataFrame,
    last_n: int = 100,
    time: str = "windowStart",
    mean: str = "avgPressureHpa",
    others: tuple[str, ...] = ("minPressureHpa", "maxPressureHpa", "measurementCount"),
) -> DataFrame:
    """The last n windows that have a mean, oldest first, for a min-max band chart.

    Key columns, where there are any, order windows of the same start.
    """
    ties = tuple(name for name in GROUP_KEYS if name in stats.columns)
    last = newest(complete_rows(stats, time, mean), last_n, time, ties)
    return last.orderBy(time, *ties).select(time, mean, *others)


def day_series(cache: DataFrame, day: str | dt.date) -> DataFrame:
    """The windows of one day that have a mean, in time order."""
    rows = complete_rows(on_day(cache, day), "window_start", "avg_pressure_hpa")
    return by_start(
        rows.select(
            "window_start",
            "avg_pressure_hpa",
            "min_pressure_hpa",
            "max_pressure_hpa",
            "measurement_count",
        )
    )


def first_row(rows: DataFrame):
    return rows.first()


def preview(rows: DataFrame, n: int = 20) -> None:
    """Schema and first rows on the console."""
    rows.printSchema()
    rows.show(n, truncate=False)


def thinned(
    series: DataFrame,
    points: int,
    time: str = "window_start",
    mean: str = "avg_pressure_hpa",
    low: str = "min_pressure_hpa",
    high: str = "max_pressure_hpa",
    count: str = "measurement_count",
) -> DataFrame:
    """A band series of any length as at most ``points`` rows, for a chart of that width.

    The time range is cut into equal spans; each gives its first time, its mean
    weighted by count, its least and greatest value and its count. All rows
    count. Rows without a time are left out.
    """
    if points < 1:
        raise ValueError("a chart needs a point")
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    first, last = series.agg(F.min(micros), F.max(micros)).first()
    width = ((last or 0) - (first or 0)) // points + 1
    span = F.floor((micros - F.lit(first or 0)) / F.lit(width))
    weighted = F.sum(F.col(mean) * F.col(count)) / F.sum(count)
    return (
        series.filter(F.col(time).isNotNull())
        .groupBy(span.alias("_span"))
        .agg(
            F.min(time).alias(time),
            weighted.alias(mean),
            F.min(low).alias(low),
            F.max(high).alias(high),
            F.sum(count).alias(count),
        )
        .drop("_span")
        .orderBy(time)
    )


def local_frame(rows: DataFrame, most: int) -> pd.DataFrame:
    """A series as a local frame for plotting.

    More rows than ``most`` is an error rather than a cut: thin the series, or
    allow for more.
    """
    frame = rows.limit(most + 1).toPandas()
    if len(frame) > most:
        raise ValueError(f"more than {most} rows; thin the series or raise the bound")
    return frame
