"""Health log, lake and windows from one stream, closed and open windows."""

from __future__ import annotations

import math
import time

import pytest
from pyspark.java_gateway import ensure_callback_server_started
from pyspark.sql import functions as F

from barograph.operators.envelopes import FOR_STATS, parse_messages
from barograph.operators.windows import window_stats
from barograph.schema import GROUP_KEYS
from barograph.settings import Trigger, WindowSpec
from barograph.sources.messages import replay_stream
from barograph.streaming.bronze import start_bronze
from barograph.streaming.closed import closed_windows, open_windows, start_closed_windows
from barograph.streaming.fanout import LakeAndWindows
from barograph.streaming.health import HEALTH, health_log, health_table, observed
from conftest import START, envelope

NOW = Trigger()
SHORT = WindowSpec("10 seconds", "5 seconds")


def seconds(frame, *columns):
    return frame.select(*[
        (F.unix_seconds(c) - START).alias(c) if c.endswith(("Start", "End", "event", "start", "end")) else c
        for c in columns
    ])


# --- health ------------------------------------------------------------------------


def test_batches_report_what_they_took_in(spark, bus, tmp_path):
    health = str(tmp_path / "health")
    lake, checkpoint = str(tmp_path / "lake"), str(tmp_path / "checkpoint")

    def run(log):
        query = start_bronze(observed(parse_messages(replay_stream(spark, bus.path))), lake, checkpoint, NOW)
        query.awaitTermination()
        begun = time.monotonic()
        assert log.wait([query])
        assert time.monotonic() - begun < 5

    with health_log(spark, health) as log:
        bus.send([envelope(3), "no json", None, envelope(9)])
        run(log)
        run(log)  # nothing new: no row
        bus.send(["{", '{"timestamp": 1e30}'])
        run(log)
    bus.send([envelope(100)])
    query = start_bronze(observed(parse_messages(replay_stream(spark, bus.path))), lake, checkpoint, NOW)
    query.awaitTermination()  # no log listens
    table = health_table(spark, health)
    assert table.schema.names == HEALTH.names
    rows = seconds(table, "rows", "unparsed", "first_event", "last_event", "batch_id").collect()
    assert sorted(map(tuple, rows)) == [(2, 2, None, None, rows[0].batch_id + rows[1].batch_id), (4, 2, 3, 9, 0)]
    assert table.select("query_id").distinct().count() == 1


# --- lake and windows --------------------------------------------------------------


def merged_stats(stores, wanted=None):
    rows = seconds(stores.stats(wanted), "walkId", "windowStart", "measurementCount", "avgPressureHpa",
                   "stddevPressureHpa").collect()
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in rows)


def plain_stats(spark, values, spec):
    frame = spark.createDataFrame(
        [("w1", "d", "b", s, p) for s, p in values],
        "walkId string, deviceId string, sensorType string, second long, pressureHpa double")
    frame = frame.withColumn("eventTime", F.timestamp_seconds((F.col("second") + START).cast("long")))
    rows = seconds(window_stats(frame, spec), "walkId", "windowStart", "measurementCount",
                   "avgPressureHpa", "stddevPressureHpa").collect()
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in rows)


def test_both_stores_hold_the_same_batches(spark, bus, tmp_path, monkeypatch):
    stores = LakeAndWindows(spark, str(tmp_path / "stores"), SHORT)
    assert stores.lake().collect() == [] and stores.stats().collect() == []
    sent = [(1, 970.0), (4, 972.0), (7, 971.5)]
    bus.send([envelope(s, p) for s, p in sent] + ["broken"])
    stores.start(replay_stream(spark, bus.path), NOW).awaitTermination()
    assert stores.lake().count() == 4
    assert merged_stats(stores) == plain_stats(spark, sent, SHORT)

    # The second batch fails between the two writes: neither store shows it.
    late = [(2, 900.0), (30, 950.0)]
    bus.send([envelope(s, p) for s, p in late])
    with monkeypatch.context() as broken:
        def fails(self, batch_id):
            raise RuntimeError("killed between the writes")
        broken.setattr(LakeAndWindows, "store_panes", fails)
        with pytest.raises(Exception, match="killed between the writes"):
            stores.start(replay_stream(spark, bus.path), NOW).awaitTermination()
    written = spark.read.parquet(stores.lake_path).count()
    assert written == 6 and stores.lake().count() == 4
    assert merged_stats(stores) == plain_stats(spark, sent, SHORT)

    # Started again, the batch replaces what it wrote; late rows count in their windows.
    stores = LakeAndWindows(spark, str(tmp_path / "stores"), SHORT)
    stores.start(replay_stream(spark, bus.path), NOW).awaitTermination()
    assert stores.lake().count() == 6
    assert merged_stats(stores) == plain_stats(spark, sent + late, SHORT)
    # Wider windows of whole panes, without the rows.
    wide = WindowSpec("30 seconds", "15 seconds")
    assert merged_stats(stores, wide) == plain_stats(spark, sent + late, wide)


def test_a_batch_is_parsed_once(spark, bus, tmp_path):
    bus.send([envelope(1), envelope(2)])
    plans = []
    stores = LakeAndWindows(spark, str(tmp_path / "stores"), SHORT)

    class Seen:
        def onSuccess(self, name, execution, nanos):
            plans.append(execution.optimizedPlan().toString())

        def onFailure(self, name, execution, error):
            pass

        class Java:
            implements = ["org.apache.spark.sql.util.QueryExecutionListener"]

    ensure_callback_server_started(spark.sparkContext._gateway)
    seen = Seen()
    manager = spark._jsparkSession.listenerManager()
    manager.register(seen)
    try:
        stores.store(spark.read.parquet(bus.path), 0)
        end = time.monotonic() + 20
        while len(plans) < 2 and time.monotonic() < end:
            time.sleep(0.1)
    finally:
        manager.unregister(seen)
    assert len(plans) >= 2 and sum(plan.count("from_json") for plan in plans) == 1


def test_stores_refuse_a_lost_checkpoint(spark, bus, tmp_path):
    bus.send([envelope(1)])
    stores = LakeAndWindows(spark, str(tmp_path / "stores"), SHORT)
    stores.start(replay_stream(spark, bus.path), NOW).awaitTermination()
    (tmp_path / "stores" / "checkpoint").rename(tmp_path / "elsewhere")
    with pytest.raises(RuntimeError, match="checkpoint"):
        stores.start(replay_stream(spark, bus.path), NOW)


# --- closed and open windows -------------------------------------------------------


def test_closed_windows_are_written_once(spark, bus, tmp_path):
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    spec = WindowSpec("10 seconds", None, "20 seconds")

    def run(*messages):
        bus.send(list(messages))
        stats = window_stats(parse_messages(replay_stream(spark, bus.path), wanted=FOR_STATS), spec)
        start_closed_windows(stats, table, checkpoint, NOW, partitions=2).awaitTermination()
        closed = seconds(closed_windows(spark, table), "window_start", "measurement_count", "max_pressure_hpa")
        still = seconds(open_windows(spark, checkpoint, GROUP_KEYS), "windowStart", "measurementCount",
                        "avgPressureHpa", "stddevPressureHpa")
        return sorted(map(tuple, closed.collect())), sorted(map(tuple, still.collect()))

    closed, still = run(envelope(5, 1.0), envelope(6, 3.0), envelope(27, 7.0))
    # The watermark is at 7: nothing has closed.
    assert closed == [] and still == [(0, 2, 2.0, math.sqrt(2)), (20, 1, 7.0, None)]
    closed, still = run(envelope(8, 5.0), envelope(41, None))
    # A late row counts while its window is open; at 21 the window closes.
    assert closed == [(0, 3, 5.0)] and still == [(20, 1, 7.0, None), (40, 1, None, None)]
    closed, still = run(envelope(9, 100.0), envelope(29, 8.0), envelope(12, 50.0), envelope(70, 2.0))
    # The window from 0 is written and stays; the one from 10 has closed unseen.
    assert closed == [(0, 3, 5.0), (20, 2, 8.0), (40, 1, None)] and still == [(70, 1, 2.0, None)]
    closed, still = run("no json")
    assert len(closed) == 3 and len(still) == 1
    dates = closed_windows(spark, table).select("window_date", F.to_date("window_start")).distinct()
    assert all(one == other for one, other in dates.collect())
