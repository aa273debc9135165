"""Named live tables."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from barograph.settings import Trigger
from barograph.streaming.starting import require_checkpoint, start_stream
from barograph.workspace import LastDone, age_seconds, drop_folder, listed


def start_live_table(
    stats: DataFrame,
    name: str,
    root: str,
    trigger: Trigger = Trigger(every=5),
    versions: int = 3,
    keep_seconds: float = 600,
    partitions: int | None = None,
) -> StreamingQuery:
    """Keep a temporary view ``name`` equal to the whole result of an aggregation.

    Complete mode: each trigger gives the full table and late rows always count,
    so state is never dropped. The tasks write the table as files and the view
    turns to them when they are all there; no row passes through the driver, as
    all of them would with Spark's memory sink.
    Each version has a folder of its own. It goes once ``versions`` newer ones are
    there and it was replaced ``keep_seconds`` ago: so long a reader may take.

    Where the key space keeps growing, use ``ResultCache.start(..., view=name)``.
    """
    spark = stats.sparkSession
    checkpoint = f"{root}/checkpoint"
    tables = f"{root}/table"
    done = LastDone(spark, f"{root}/shown")
    require_checkpoint(spark, checkpoint, tables)

    def folder(batch_id: int) -> str:
        return f"{tables}/version={batch_id}"

    def show(batch_id: int | None) -> None:
        if batch_id is None:
            table = spark.createDataFrame([], stats.schema)
        else:
            table = spark.read.schema(stats.schema).parquet(folder(batch_id))
        table.createOrReplaceTempView(name)

    def publish(table: DataFrame, batch_id: int) -> None:
        table.write.mode("overwrite").parquet(folder(batch_id))
        done.mark(batch_id)
        show(batch_id)
        numbers = sorted(int(x.rpartition("=")[2]) for x in listed(spark, f"{tables}/version=*"))
        # A version was in use until the next one was written.
        for old, following in zip(numbers, numbers[1:]):
            if old <= batch_id - versions and age_seconds(spark, folder(following)) > keep_seconds:
                drop_folder(spark, folder(old))

    if name not in [query.name for query in spark.streams.active]:
        show(done.last())
    writer = stats.writeStream.foreachBatch(publish).outputMode("complete")
    return start_stream(spark, writer, checkpoint, trigger, name, partitions)


def poll(
    spark: SparkSession,
    name: str,
    read: Callable[[DataFrame], object],
    rounds: int = 60,
    period: float = 5.0,
) -> list:
    """Hand the live table to ``read`` every ``period`` seconds; return its answers."""
    answers = []
    for turn in range(rounds):
        if turn:
            time.sleep(period)
        answers.append(read(spark.table(name)))
    return answers
