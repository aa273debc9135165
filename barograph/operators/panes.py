"""Sliding-window statistics by panes that windows share.

A pane is as long as the greatest span that divides both the window's size and
its slide, so every window is a run of whole panes. Rows are aggregated once,
to their pane, instead of once for each window they lie in; panes are then
merged into windows by the pairwise formula for counts, means and squared
deviations.
"""

from __future__ import annotations

import re
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.schema import GROUP_KEYS
from barograph.settings import WindowSpec

MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
#: Of a pane: rows, rows with a value, their sum, squared deviations from their mean, extremes.
MOMENTS = ("measurementCount", "valueCount", "total", "squares", "low", "high")


def span_micros(span: str) -> int:
    """Microseconds of a span such as ``1 hour 30 minutes``; months have no fixed length."""
    parts = re.findall(r"(\d+)\s*([a-z]+?)s?(?=\s|\d|$)", span.strip().lower().removeprefix("interval "))
    if not parts or any(unit not in MICROS for _, unit in parts):
        raise ValueError(f"not a span of weeks to microseconds: {span!r}")
    return sum(int(count) * MICROS[unit] for count, unit in parts)


def shape_of(spec: WindowSpec) -> tuple[int, int, int]:
    """Size, slide and pane in microseconds."""
    size = span_micros(spec.size)
    slide = span_micros(spec.slide) if spec.slide else size
    if not 0 < slide <= size:
        raise ValueError(f"slide must be above zero and not above the size: {spec}")
    return size, slide, gcd(size, slide)


def pane_rows(
    measurements: DataFrame,
    spec: WindowSpec = WindowSpec(),
    keys: tuple[str, ...] = GROUP_KEYS,
    time: str = "eventTime",
    value: str = "pressureHpa",
) -> DataFrame:
    """One row per pane and key, in batch and stream alike.

    A stream keeps state for each pane, not for each window, so an hour sliding
    by a minute takes a sixtieth of the state. Rows without a time fall out;
    rows without a value count in ``measurementCount`` alone.
    """
    *_, pane = shape_of(spec)
    number = F.col(value).cast("double")
    return (
        measurements.select(time, *keys, value)
        .withWatermark(time, spec.watermark)
        .groupBy(F.window(time, f"{pane} microseconds").alias("span"), *keys)
        .agg(
            F.count("*").alias("measurementCount"),
            F.count(value).alias("valueCount"),
            F.sum(number).alias("total"),
            (F.var_pop(number) * F.count(value)).alias("squares"),
            F.min(number).alias("low"),
            F.max(number).alias("high"),
        )
        .select(F.col("span.start").alias("paneStart"), *keys, *MOMENTS)
    )


def merged(one: Column, other: Column) -> Column:
    """Two structs of ``MOMENTS`` as one. NULL and NaN count as they do in aggregates."""
    count = one.valueCount + other.valueCount
    apart = F.try_divide(other.total, other.valueCount) - F.try_divide(one.total, one.valueCount)
    between = F.try_divide(apart * apart * one.valueCount * other.valueCount, count)
    return F.struct(
        (one.measurementCount + other.measurementCount).alias("measurementCount"),
        count.alias("valueCount"),
        F.coalesce(one.total + other.total, one.total, other.total).alias("total"),
        F.coalesce(one.squares + other.squares + between, one.squares, other.squares).alias("squares"),
        F.least(one.low, other.low).alias("low"),
        F.greatest(one.high, other.high).alias("high"),
    )


def nothing() -> Column:
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("double")
    return F.struct(*[
        (zero if name.endswith("Count") else none).alias(name) for name in MOMENTS
    ])


def pane_windows(
    panes: DataFrame,
    spec: WindowSpec = WindowSpec(),
    keys: tuple[str, ...] = GROUP_KEYS,
    value: str = "pressureHpa",
) -> DataFrame:
    """Windows of ``pane_rows``, as ``window_stats`` gives them.

    A pane may be there several times, as partial results of several batches.
    Panes are shuffled by key and by blocks of time, a block holding the window
    starts of about one window's size. A pane is wanted by windows of two blocks
    at most, so it is sent twice, not once for each of its windows; and a key
    with most of the rows is spread over its blocks.
    """
    size, slide, _ = shape_of(spec)
    span = -(-size // slide) * slide
    at = F.unix_micros("paneStart")

    def floor_to(micros: Column, step: int) -> Column:
        return micros - F.pmod(micros, F.lit(step))

    earliest = floor_to(at - size, slide) + slide
    blocks = F.array_distinct(F.array(floor_to(earliest, span), floor_to(at, span)))
    pane = F.struct(at.alias("at"), F.struct(*MOMENTS).alias("own"))
    dealt = panes.select(*keys, pane.alias("pane"), F.explode(blocks).alias("block"))
    together = dealt.groupBy(*keys, "block").agg(F.array_sort(F.collect_list("pane")).alias("panes"))

    def window_from(start: Column) -> Column:
        inside = F.filter("panes", lambda x: (x.at >= start) & (x.at < start + size))
        whole = F.aggregate(inside, nothing(), lambda all, x: merged(all, x.own))
        return F.struct(start.alias("start"), whole.alias("all"))

    starts = F.sequence(F.col("block"), F.col("block") + (span - slide), F.lit(slide).cast("bigint"))
    rows = together.select(*keys, F.inline(F.transform(starts, window_from)))
    title = value[0].upper() + value[1:]
    count = F.col("all.valueCount")
    return rows.filter("all.measurementCount > 0").select(
        F.timestamp_micros("start").alias("windowStart"),
        F.timestamp_micros(F.col("start") + size).alias("windowEnd"),
        *keys,
        F.col("all.measurementCount").alias("measurementCount"),
        F.try_divide("all.total", count).alias(f"avg{title}"),
        F.col("all.low").alias(f"min{title}"),
        F.col("all.high").alias(f"max{title}"),
        F.when(count > 1, F.sqrt(F.col("all.squares") / (count - 1))).alias(f"stddev{title}"),
    )


def pane_stats(
    measurements: DataFrame,
    spec: WindowSpec = WindowSpec(),
    keys: tuple[str, ...] = GROUP_KEYS,
    time: str = "eventTime",
    value: str = "pressureHpa",
) -> DataFrame:
    """``window_stats`` of a batch, by panes: for windows that overlap much."""
    return pane_windows(pane_rows(measurements, spec, keys, time, value), spec, keys, value)
