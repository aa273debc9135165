"""Batch scans of text, sensor logs and the bronze lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph.schema import BRONZE, SENSOR_LOG
from barograph.session import scoped_conf

#: Tasks per core that list the folders of many logs.
LISTING_TASKS = 4


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line in ``value``; lines end at LF, CR LF or a lone CR."""
    return spark.read.text(path)


def sensor_log(
    spark: SparkSession,
    path: str | list[str],
    mode: str = "FAILFAST",
    corrupt_column: str | None = None,
) -> DataFrame:
    """CSV log of elapsed seconds and pressure, as ``timeSeconds``, ``pressureHpa``.

    A leading byte-order mark is dropped. A cell that is not a number fails the
    job; with ``mode="PERMISSIVE"`` it is NULL, and ``corrupt_column`` keeps the
    raw line.
    """
    kept = ["`Time (s)` AS timeSeconds", "`X (hPa)` AS pressureHpa"]
    rows = _logged(spark, path, mode, corrupt_column)
    return rows.selectExpr(*kept, *([corrupt_column] if corrupt_column else []))


def sensor_logs(
    spark: SparkSession,
    path: str | list[str],
    bases: DataFrame,
    walk: str = r"([^/]+)\.csv$",
    mode: str = "FAILFAST",
) -> DataFrame:
    """Logs of many walks in one scan: ``walkId, baseEpoch, timeSeconds, pressureHpa``.

    Each file below ``path`` is one walk's, or part of it; ``walk`` is a pattern
    whose first group finds the walk in the file's path. ``bases`` has columns
    ``walkId`` and ``baseEpoch``, the time at which each walk's clock began; a
    walk without a row keeps its rows, with a NULL base and so no event time.
    Files of any size are read in splits, so a walk with most of the data has
    many tasks. Spark sends the bases to all tasks while they are small, and
    otherwise splits a walk that is too much for one. A few tasks per core list
    the folders, however many: Spark alone takes one per folder, up to 10,000.
    """
    listing = LISTING_TASKS * spark.sparkContext.defaultParallelism
    with scoped_conf(
        spark, spark__sql__sources__parallelPartitionDiscovery__parallelism=str(listing)
    ):
        rows = _logged(spark, path, mode, None, recursiveFileLookup=True)
    # The path is URL-encoded; a plus sign in it is one.
    place = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    named = rows.select(
        F.regexp_extract(place, walk, 1).alias("walkId"),
        F.col("`Time (s)`").alias("timeSeconds"),
        F.col("`X (hPa)`").alias("pressureHpa"),
    )
    return named.join(bases.select("walkId", "baseEpoch"), "walkId", "left").select(
        "walkId", "baseEpoch", "timeSeconds", "pressureHpa"
    )


def _logged(
    spark: SparkSession, path: str | list[str], mode: str, corrupt_column: str | None, **more
) -> DataFrame:
    layout = T.StructType(list(SENSOR_LOG.fields))
    options = {"header": True, "mode": mode, "encoding": "UTF-8", "enforceSchema": False}
    if corrupt_column:
        layout.add(corrupt_column, T.StringType())
        options |= {"columnNameOfCorruptRecord": corrupt_column, "mode": "PERMISSIVE"}
    return spark.read.schema(layout).options(**options, **more).csv(path)


def bronze_table(spark: SparkSession, path: str) -> DataFrame:
    """The lake, by declared layout.

    Declaring it saves reading footers and keeps a sensor type such as ``007``
    text, which partition discovery alone would turn into a number.
    """
    return spark.read.schema(BRONZE).parquet(path)
