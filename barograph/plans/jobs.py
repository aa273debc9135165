"""Whole jobs: sensor log to messages, messages to lake, live table and cache, text counts."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from barograph.operators.envelopes import FOR_STATS, as_bus_rows, parse_messages, to_envelopes
from barograph.operators.offsets import with_offsets
from barograph.operators.reports import (
    band_series,
    day_series,
    local_frame,
    rows_per_day,
    thinned,
    time_range,
)
from barograph.operators.textstats import text_totals
from barograph.operators.windows import window_stats
from barograph.session import pin_utc
from barograph.settings import BusOptions, CacheFilter, Trigger, WindowSpec
from barograph.sources.files import sensor_log, text_lines
from barograph.streaming.bronze import publish_messages, start_bronze, write_messages
from barograph.streaming.live import start_live_table
from barograph.streaming.monitor import query_status, run_for, stop_all
from barograph.streaming.resultcache import ResultCache


@dataclass(frozen=True)
class LiveJob:
    """Messages to a live table and, side by side, to the bronze lake."""

    table: str
    table_root: str
    bronze_path: str
    bronze_checkpoint: str
    windows: WindowSpec = WindowSpec()
    table_trigger: Trigger = Trigger(every=5)
    bronze_trigger: Trigger = Trigger(every=10)
    partitions: int | None = None
    files_per_folder: int | None = None
    keep_seconds: float = 600


def start_live_job(messages: DataFrame, job: LiveJob) -> list[StreamingQuery]:
    """Two queries over one stream; each reads the source and parses what it needs."""
    pin_utc(messages.sparkSession)
    measured = parse_messages(messages)
    table = start_live_table(
        window_stats(parse_messages(messages, wanted=FOR_STATS), job.windows),
        job.table,
        job.table_root,
        job.table_trigger,
        keep_seconds=job.keep_seconds,
        partitions=job.partitions,
    )
    try:
        lake = start_bronze(
            measured,
            job.bronze_path,
            job.bronze_checkpoint,
            job.bronze_trigger,
            files_per_folder=job.files_per_folder,
            partitions=job.partitions,
        )
    except BaseException:
        stop_all([table])
        raise
    return [table, lake]


def chart_feed(
    spark: SparkSession,
    queries: list[StreamingQuery],
    table: str,
    last_n: int = 100,
    rounds: int = 60,
    period: float = 5.0,
) -> Iterator[tuple[pd.DataFrame, list[dict]]]:
    """Every ``period`` seconds the newest ``last_n`` windows of the live table, for a chart,
    and the state of the queries. Ends early once none of them runs."""
    for turn in range(rounds):
        if turn:
            time.sleep(period)
        series = local_frame(band_series(spark.table(table), last_n), last_n)
        states = [query_status(query) for query in queries]
        yield series, states
        if not any(state["active"] for state in states):
            return


@dataclass(frozen=True)
class CacheJob:
    """Messages to the result cache, then reads from it.

    ``compact_every`` seconds the job compacts what is committed and drops what
    that covers; readers of the ``view`` have until the next time to finish.
    """

    root: str
    windows: WindowSpec = WindowSpec()
    trigger: Trigger = Trigger(every=10)
    run_seconds: float = 60
    name: str | None = None
    view: str | None = None
    partitions: int | None = None
    files_per_date: int | None = None
    compact_every: float | None = 600
    report: Callable[[dict], None] | None = None


@dataclass(frozen=True)
class CacheReport:
    rows: DataFrame
    time_range: DataFrame
    per_day: DataFrame
    day: DataFrame | None

    def day_frame(self, points: int = 2_000) -> pd.DataFrame:
        """The day's series as a local frame for plotting, thinned to ``points`` rows."""
        return local_frame(thinned(self.day, points), points)


def run_cache_job(
    messages: DataFrame, job: CacheJob, wanted: CacheFilter, day: str | dt.date | None = None
) -> CacheReport:
    """Fill the cache for a while, stop the query whatever happens, report."""
    spark = messages.sparkSession
    pin_utc(spark)
    cache = ResultCache(spark, job.root)
    query = cache.start(
        window_stats(parse_messages(messages, wanted=FOR_STATS), job.windows),
        job.trigger,
        name=job.name,
        view=job.view,
        files_per_date=job.files_per_date,
        partitions=job.partitions,
    )
    try:
        left = job.run_seconds
        while left > 0:
            span = min(left, job.compact_every or left)
            running = run_for(query, span, period=min(span, 5.0), report=job.report or (lambda state: None))
            left -= span
            if job.compact_every:
                # What the compaction before this one covers; the view has turned from it since.
                cache.drop_compacted()
                cache.compact()
                cache.show(job.view)
            if not running:
                break
    finally:
        stop_all([query])
    return report_cache(cache, wanted, day)


def report_cache(
    cache: ResultCache, wanted: CacheFilter, day: str | dt.date | None = None
) -> CacheReport:
    rows = cache.read(wanted)
    return CacheReport(
        rows=rows,
        time_range=time_range(rows),
        per_day=rows_per_day(rows),
        day=day_series(cache.read(wanted, day), day) if day is not None else None,
    )


def send_sensor_log(
    spark: SparkSession,
    log_path: str,
    replay_path: str | None,
    user: str,
    device: str,
    walk: str,
    sensor: str,
    base_epoch: float,
    topic: str,
    bus: BusOptions | None = None,
    partitions: int | None = None,
) -> None:
    """A CSV sensor log to messages, on all tasks at once: to a replay folder, or to ``bus``.

    With ``partitions`` the folder's messages are dealt by key and numbered
    without gaps, in the order of their elapsed time, as a bus would; without,
    they are numbered as they come, which needs no shuffle.
    """
    log = sensor_log(spark, log_path)
    keyed = to_envelopes(log, user, device, walk, sensor, base_epoch, keep=("timeSeconds",))
    if bus is not None:
        publish_messages(keyed.drop("timeSeconds"), bus)
    elif partitions:
        write_messages(with_offsets(keyed, topic, partitions, ("timeSeconds",)), replay_path)
    else:
        write_messages(as_bus_rows(keyed, topic), replay_path)


def count_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Characters, words and lines of text files, one row each."""
    return text_totals(text_lines(spark, path))
