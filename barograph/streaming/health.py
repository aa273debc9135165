"""What each micro-batch took in, pushed by Spark as the batch ends.

Counts come from the batch itself by ``observe``, at no further pass over the
rows; a listener writes them as one row per batch to a folder of JSON files.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
)

from barograph.schema import layout
from barograph.workspace import write_text

HEALTH = layout({
    "query_id": "string",
    "batch_id": "bigint",
    "rows": "bigint",
    "unparsed": "bigint",
    "first_event": "timestamp",
    "last_event": "timestamp",
    "rows_per_second": "double",
    "watermark": "string",
})
#: Name of the observed metrics.
OBSERVED = "messages"


def observed(measurements: DataFrame) -> DataFrame:
    """The same rows, counted on the way: all, those without an event time, and the time range.

    Of a message without an event time the text could not be parsed, or names no
    time; the lake keeps it in its default date partition (``bad_rows``).
    """
    time = F.col("eventTime")
    return measurements.observe(
        OBSERVED,
        F.count("*").alias("rows"),
        F.count_if(time.isNull()).alias("unparsed"),
        F.unix_micros(F.min(time)).alias("first_event"),
        F.unix_micros(F.max(time)).alias("last_event"),
    )


class HealthLog(StreamingQueryListener):
    """Writes a file per batch of the queries whose rows are ``observed``.

    A batch's file has its number for a name, so a batch that runs again after a
    failure replaces its row. A batch without rows writes none: it would only
    tell that nothing came.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(OBSERVED)
        if found is None or not found["rows"]:
            return
        row = {
            "query_id": str(progress.id),
            "batch_id": progress.batchId,
            **found.asDict(),
            "rows_per_second": progress.processedRowsPerSecond,
            "watermark": progress.eventTime.get("watermark"),
        }
        path = f"{self.folder}/query_id={progress.id}/{progress.batchId}.json"
        write_text(self.spark, path, json.dumps(row))

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        self._end_of(str(event.runId)).set()

    def _end_of(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def wait(self, queries: Iterable[StreamingQuery], seconds: float = 30) -> bool:
        """Wait until ended queries have reported all; events come a little after the end."""
        return all(self._end_of(str(query.runId)).wait(seconds) for query in queries)


@contextmanager
def health_log(spark: SparkSession, folder: str) -> Iterator[HealthLog]:
    """A log at work for all queries of the session that start within the block."""
    log = HealthLog(spark, folder)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)


def health_table(spark: SparkSession, folder: str) -> DataFrame:
    """One row per micro-batch and query that had rows."""
    stored = layout({
        field.name: "bigint" if field.name.endswith("_event") else field.dataType
        for field in HEALTH.fields if field.name != "query_id"
    } | {"query_id": "string"})
    rows = spark.read.schema(stored).json(folder)
    return rows.select(*[
        F.timestamp_micros(name).alias(name) if name.endswith("_event") else F.col(name)
        for name in HEALTH.names
    ])
