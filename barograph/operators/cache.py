"""Result-cache rows and their newest versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.schema import CACHE, CACHE_KEY, snake_case


def cache_rows(stats: DataFrame) -> DataFrame:
    """Window statistics in cache layout, stamped with the time of writing."""
    renamed = stats.withColumnsRenamed({name: snake_case(name) for name in stats.columns})
    return renamed.select(
        *[
            F.current_timestamp().alias(column.name)
            if column.name == "updated_at"
            else F.col(column.name).cast(column.dataType)
            for column in CACHE.fields
        ]
    )


def latest_wins(
    changes: DataFrame, keys: tuple[str, ...] = CACHE_KEY, version: str = "batch_id"
) -> DataFrame:
    """One row per key: the one with the highest version.

    ``max_by`` over plain columns is a hash aggregate with a map-side part, so a
    key with very many versions is cut down before the shuffle and nothing is
    sorted. Filters on key columns pass through it to the scan.
    """
    values = [name for name in changes.columns if name != version and name not in keys]
    return changes.groupBy(*keys).agg(*[F.max_by(name, version).alias(name) for name in values])
