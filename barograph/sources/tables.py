"""Named tables and connector tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def live_table(spark: SparkSession, name: str) -> DataFrame:
    """The current content of a live table (see ``streaming.live``)."""
    return spark.table(name)


def connector_table(spark: SparkSession, connector: str, **options: str) -> DataFrame:
    """A result table kept in an external store, through that store's own connector."""
    return spark.read.format(connector).options(**options).load()
