"""What all stream starts share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from barograph.session import scoped_conf
from barograph.settings import Trigger
from barograph.workspace import listed, path_exists

# Window state in RocksDB, and per batch only its changes sent to the checkpoint.
STATE = {
    "spark__sql__streaming__stateStore__providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled": "true",
}


def start_stream(
    spark: SparkSession,
    writer: DataStreamWriter,
    checkpoint: str,
    trigger: Trigger,
    name: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Start with window state in RocksDB, which holds more keys than the heap can.

    ``partitions`` is the number of state partitions and of tasks after a shuffle,
    by default the session's. The checkpoint keeps that of the first start.
    A second query of the same name in one session is refused by Spark.
    """
    settings = dict(STATE)
    if partitions:
        settings["spark__sql__shuffle__partitions"] = str(partitions)
    writer = writer.option("checkpointLocation", checkpoint).trigger(**trigger.options())
    if name:
        writer = writer.queryName(name)
    with scoped_conf(spark, **settings):
        return writer.start()


def require_checkpoint(spark: SparkSession, checkpoint: str, output: str) -> None:
    """Refuse to go on where output and checkpoint don't belong together.

    From a fresh checkpoint batch numbers would start at 0 again, and output
    that remembers higher ones would skip or hide the new batches. With the
    output gone, a checkpoint that has commits would go on behind the lost rows.
    """
    if path_exists(spark, output):
        if not path_exists(spark, f"{checkpoint}/metadata"):
            raise RuntimeError(
                f"{output} holds batches, but its checkpoint {checkpoint} is gone: "
                "restore the checkpoint or start with a new output folder"
            )
    elif listed(spark, f"{checkpoint}/commits/[0-9]*"):
        raise RuntimeError(
            f"checkpoint {checkpoint} has committed batches, but their output {output} is gone: "
            "restore the output or start with a new checkpoint"
        )


def spread_over_files(
    rows: DataFrame, folders: list[Column], by: Sequence[str], files: int
) -> DataFrame:
    """Bring the rows of an output folder together into at most ``files`` tasks.

    For loads that touch many folders at once: without it each task writes a file
    to each folder. The salt keeps a folder with much of the data on many tasks.
    """
    return rows.repartition(*folders, F.pmod(F.xxhash64(*by), F.lit(files)))
