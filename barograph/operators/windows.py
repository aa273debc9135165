"""Event-time window statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.schema import GROUP_KEYS
from barograph.settings import WindowSpec


def window_stats(
    measurements: DataFrame,
    spec: WindowSpec = WindowSpec(),
    keys: tuple[str, ...] = GROUP_KEYS,
    time: str = "eventTime",
    value: str = "pressureHpa",
) -> DataFrame:
    """Count, mean, min, max and sample deviation per window and key.

    Windows are ``[start, end)`` and aligned to the epoch. Rows without an event
    time fall out; rows without a value count but do not enter the statistics.

    Each task reduces its rows to one per window and key before the shuffle, so
    a walk that sends a third of all rows adds no more to a reducer than any
    other. On a batch the watermark has no effect.
    """
    span = F.window(time, spec.size, spec.slide) if spec.slide else F.window(time, spec.size)
    title = value[0].upper() + value[1:]
    measures = {"avg": F.avg, "min": F.min, "max": F.max, "stddev": F.stddev}
    return (
        measurements.select(time, *keys, value)
        .withWatermark(time, spec.watermark)
        .groupBy(span.alias("span"), *keys)
        .agg(
            F.count("*").alias("measurementCount"),
            *[measure(value).alias(name + title) for name, measure in measures.items()],
        )
        .select(
            F.col("span.start").alias("windowStart"),
            F.col("span.end").alias("windowEnd"),
            *keys,
            "measurementCount",
            *[name + title for name in measures],
        )
    )
