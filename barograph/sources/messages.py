"""Message scans.

A bus topic and its file replay have the same columns (``schema.MESSAGE``), so
everything downstream takes either.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from barograph.schema import MESSAGE
from barograph.settings import BusOptions


def bus_reader_options(bus: BusOptions) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": bus.servers,
        "subscribe": bus.topic,
        "startingOffsets": bus.starting_offsets,
        "maxOffsetsPerTrigger": bus.max_offsets_per_trigger,
        "minPartitions": bus.min_partitions,
        **bus.extra,
    }
    return {key: str(value) for key, value in options.items() if value is not None}


def bus_stream(spark: SparkSession, bus: BusOptions) -> DataFrame:
    """Unbounded scan of one topic.

    ``starting_offsets`` counts for a fresh checkpoint only; a restarted stream
    goes on from where its checkpoint says.
    """
    if bus.starting_offsets not in ("earliest", "latest"):
        raise ValueError("starting_offsets must be 'earliest' or 'latest'")
    reader = spark.readStream.format("kafka").options(**bus_reader_options(bus))
    try:
        return reader.load()
    except AnalysisException as error:
        raise missing_connector(error) from error


def missing_connector(error: Exception) -> Exception:
    """A clear error where Spark's Kafka connector is not on the class path."""
    if "kafka" in str(error).lower():
        return RuntimeError(
            "Spark's Kafka connector is not on the class path: start the session with "
            "the spark-sql-kafka-0-10 package of its own Spark and Scala version"
        )
    return error


def replay_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Messages from Parquet files, oldest file first."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def replay_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE).parquet(path)


def table_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A Parquet table, one file or a folder of them, as a stream.

    A file source wants a folder or a pattern; the pattern made here matches the
    path itself and nothing else.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")
