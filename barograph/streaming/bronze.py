"""Parquet sink of the bronze lake, and keyed message sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barograph.operators.bronze import bronze_rows
from barograph.schema import BRONZE_PARTITIONS
from barograph.settings import BusOptions, Trigger
from barograph.sources.messages import missing_connector
from barograph.streaming.starting import require_checkpoint, spread_over_files, start_stream


def start_bronze(
    measurements: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger = Trigger(every=10),
    name: str | None = None,
    files_per_folder: int | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Append measurements to the lake, in folders by event date and sensor type.

    Rows are written by the tasks that read them. ``files_per_folder`` shuffles
    them together first, for loads of old data that touch many dates per batch.
    """
    spark = measurements.sparkSession
    require_checkpoint(spark, checkpoint, f"{path}/_spark_metadata")
    rows = bronze_rows(measurements)
    if files_per_folder:
        folders = [F.col(column) for column in BRONZE_PARTITIONS]
        rows = spread_over_files(rows, folders, ["partition", "offset"], files_per_folder)
    writer = (
        rows.writeStream.format("parquet")
        .option("path", path)
        .partitionBy(*BRONZE_PARTITIONS)
        .outputMode("append")
    )
    return start_stream(spark, writer, checkpoint, trigger, name, partitions)


def write_messages(bus_rows: DataFrame, path: str) -> None:
    """Append bus rows to a replay folder (see ``sources.messages.replay_stream``)."""
    bus_rows.write.mode("append").parquet(path)


def publish_messages(keyed: DataFrame, bus: BusOptions) -> None:
    """Send ``key, value`` rows to a bus topic. Rows of one key keep one partition."""
    options = {"kafka.bootstrap.servers": bus.servers, "topic": bus.topic, **bus.extra}
    try:
        keyed.select("key", "value").write.format("kafka").options(**options).save()
    except AnalysisException as error:
        raise missing_connector(error) from error
