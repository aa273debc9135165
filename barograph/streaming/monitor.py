"""Watch and stop running queries, one's own only."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from barograph.schema import layout

STATUS = layout({
    "name": "string",
    "id": "string",
    "active": "boolean",
    "message": "string",
    "exception": "string",
    "batch_id": "bigint",
    "input_rows": "bigint",
    "rows_per_second": "double",
    "watermark": "string",
})


def query_status(query: StreamingQuery) -> dict:
    """State, error and last progress of a query, flat."""
    progress = query.lastProgress
    error = query.exception()
    rate = progress.processedRowsPerSecond if progress else None
    return {
        "name": query.name,
        "id": str(query.id),
        "active": query.isActive,
        "message": query.status["message"],
        "exception": str(error) if error else None,
        "batch_id": progress.batchId if progress else None,
        "input_rows": progress.numInputRows if progress else None,
        "rows_per_second": float(rate) if rate is not None else None,
        "watermark": progress.eventTime.get("watermark") if progress else None,
    }


def status_table(spark: SparkSession, queries: Iterable[StreamingQuery]) -> DataFrame:
    """One status row per query."""
    rows = [query_status(query) for query in queries]
    return spark.createDataFrame([tuple(row[c] for c in STATUS.names) for row in rows], STATUS)


def run_for(
    query: StreamingQuery,
    seconds: float,
    period: float = 10.0,
    report: Callable[[dict], None] = lambda status: None,
) -> bool:
    """Let a query run, reporting every ``period`` seconds.

    Returns early when it ends by itself; True if it is still running. An error
    in the query is raised here.
    """
    end = time.monotonic() + seconds
    while (left := end - time.monotonic()) > 0:
        report(query_status(query))
        if query.awaitTermination(min(period, left)):
            return False
    return query.isActive


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def stop_named(spark: SparkSession, *names: str) -> list[str]:
    """Stop the active queries of these names and no others; return what was stopped."""
    mine = [query for query in spark.streams.active if query.name in names]
    stop_all(mine)
    return [query.name for query in mine]
