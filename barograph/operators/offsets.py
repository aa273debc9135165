"""Partitions and offsets of keyed messages, as a bus gives them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barograph.operators.envelopes import as_column
from barograph.workspace import fresh_folder


def key_partition(key: Column, partitions: int) -> Column:
    """The bus partition of a key: the first 32 bits of its MD5, modulo their number.

    All messages of a key share a partition; those without one go to partition 0.
    """
    start = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(F.pmod(start, F.lit(partitions)), F.lit(0)).cast("int")


def with_offsets(
    keyed: DataFrame,
    topic: str,
    partitions: int,
    order: Sequence[str],
    sent: Column | None = None,
) -> DataFrame:
    """Keyed messages as bus rows, offsets from 0 without gaps in each partition.

    Offsets rise with ``order``, and where that ties with the place of the row
    in the input. ``order`` may name any columns of ``keyed``, nulls first.

    Two passes. The first cuts the rows by ranges of partition, order and place
    and sorts within each range, so a key with most of the messages is spread
    over many tasks, ties included; the rows are written so. The second counts
    per task and partition, adds up the counts of the tasks before, and gives
    every row its task's start plus its place there. Only the counts, a few rows
    a task, meet in one place, one partition's in a window.
    """
    spark = keyed.sparkSession
    folder = fresh_folder(spark, "offsets")
    by = ["partition", *[f"_by{n}" for n in range(len(order))], "_came"]
    rows = keyed.select(
        key_partition(F.col("key"), partitions).alias("partition"),
        (F.current_timestamp() if sent is None else sent).alias("timestamp"),
        "key",
        "value",
        *[F.col(name).alias(column) for name, column in zip(order, by[1:-1], strict=True)],
        F.monotonically_increasing_id().alias("_came"),
    )
    cut = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    # The id holds the task's number above its low 33 bits and counts the task's rows in them.
    placed = cut.select(
        "partition", "timestamp", "key", "value", F.monotonically_increasing_id().alias("_id")
    )
    placed.write.parquet(folder)
    stored = spark.read.schema(placed.schema).parquet(folder)
    task = F.shiftright("_id", 33).alias("_task")
    counts = stored.groupBy("partition", task).agg(
        F.count("*").alias("_rows"), F.min("_id").alias("_first")
    )
    before = Window.partitionBy("partition").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "partition", "_task", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    return stored.withColumn("_task", task).join(starts, ["partition", "_task"]).select(
        as_column(topic).alias("topic"),
        "partition",
        (F.col("_start") + F.col("_id") - F.col("_first")).alias("offset"),
        "timestamp",
        "key",
        "value",
    )
