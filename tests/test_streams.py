"""Streams: late data per output mode, live tables, bronze, restarts, monitoring."""

from __future__ import annotations

import pytest
from conftest import START, envelope
from pyspark.sql import functions as F

from barograph.operators.bronze import bad_rows
from barograph.operators.envelopes import parse_messages
from barograph.operators.reports import band_series, local_frame, newest
from barograph.operators.windows import window_stats
from barograph.plans.jobs import LiveJob, chart_feed, start_live_job
from barograph.session import build_session, health_check, pin_utc, scoped_conf
from barograph.settings import BusOptions, Trigger
from barograph.sources.files import bronze_table
from barograph.sources.messages import (
    bus_reader_options,
    bus_stream,
    replay_batch,
    replay_stream,
    table_stream,
)
from barograph.sources.tables import live_table
from barograph.streaming.bronze import publish_messages, start_bronze
from barograph.streaming.live import poll, start_live_table
from barograph.streaming.monitor import (
    query_status,
    run_for,
    status_table,
    stop_all,
    stop_named,
)

NOW = Trigger()

# Offsets in seconds of the messages of five micro-batches.
BATCHES = [[0, 1, 2], [300, 301], [3, 302], [400], [5, "malformed", 401]]


def fill(bus, batches=BATCHES):
    for seconds in batches:
        bus.send([envelope(s) if isinstance(s, int) else s for s in seconds])


def stats_stream(spark, bus, files_per_batch=1):
    return window_stats(parse_messages(replay_stream(spark, bus.path, files_per_batch)))


def counts(rows):
    shown = rows.select((F.unix_seconds("windowStart") - START).alias("s"), "measurementCount")
    return {r.s: r.measurementCount for r in shown.collect()}


def per_batch(spark, bus, mode, tmp_path):
    seen = []

    def collect(batch, batch_id):
        seen.append(counts(batch))

    query = (
        stats_stream(spark, bus)
        .writeStream.foreachBatch(collect)
        .outputMode(mode)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return seen


COMPLETE = {-5: 4, 0: 5, 5: 1, 295: 3, 300: 3, 395: 2, 400: 2}


def test_update_mode_gives_changed_windows_and_drops_late_rows(spark, bus, tmp_path):
    fill(bus)
    seen = per_batch(spark, bus, "update", tmp_path)
    assert [batch for batch in seen if batch] == [
        {-5: 3, 0: 3},
        {295: 2, 300: 2},
        {-5: 4, 0: 4, 295: 3, 300: 3},
        {395: 1, 400: 1},
        {395: 2, 400: 2},
    ]


def test_append_mode_gives_windows_once_closed(spark, bus, tmp_path):
    fill(bus)
    seen = per_batch(spark, bus, "append", tmp_path)
    assert [batch for batch in seen if batch] == [{-5: 4, 0: 4}, {295: 3, 300: 3}]


def test_live_table_counts_late_rows_and_keeps_to_its_name(spark, bus, tmp_path):
    fill(bus)
    query = start_live_table(stats_stream(spark, bus), "live_t", str(tmp_path / "live"), NOW)
    query.awaitTermination()
    assert counts(live_table(spark, "live_t")) == COMPLETE
    newest_first = newest(spark.table("live_t"), 2)
    assert list(counts(newest_first)) == [400, 395]
    batch = window_stats(parse_messages(replay_batch(spark, bus.path)))
    assert batch.exceptAll(live_table(spark, "live_t")).isEmpty()


def test_live_table_is_there_before_the_first_batch_and_after_a_restart(spark, bus, tmp_path):
    root = str(tmp_path / "live")
    fill(bus, [[0, 1]])
    start_live_table(stats_stream(spark, bus), "live_r", root, NOW).awaitTermination()
    before = counts(spark.table("live_r"))
    spark.catalog.dropTempView("live_r")
    query = start_live_table(stats_stream(spark, bus), "live_r", root, NOW)
    assert counts(spark.table("live_r")) == before == {-5: 2, 0: 2}
    query.awaitTermination()
    fill(bus, [[2]])
    start_live_table(stats_stream(spark, bus), "live_r", root, NOW).awaitTermination()
    assert counts(spark.table("live_r")) == {-5: 3, 0: 3}


def test_two_queries_of_one_name_are_refused(spark, bus, tmp_path):
    fill(bus, [[0]])
    first = start_live_table(
        stats_stream(spark, bus), "twice", str(tmp_path / "a"), Trigger(every=1)
    )
    try:
        with pytest.raises(Exception, match="twice"):
            start_live_table(stats_stream(spark, bus), "twice", str(tmp_path / "b"), NOW)
    finally:
        stop_all([first])


def test_band_and_poll(spark, bus, tmp_path):
    fill(bus)
    start_live_table(
        stats_stream(spark, bus), "polled", str(tmp_path / "live"), NOW
    ).awaitTermination()
    frames = poll(spark, "polled", lambda t: local_frame(band_series(t, 3), 3), rounds=2, period=0.01)
    assert [len(f) for f in frames] == [3, 3]
    assert list(frames[0]["windowStart"]) == sorted(frames[0]["windowStart"])
    assert list(frames[0]["measurementCount"]) == [3, 2, 2]
    with pytest.raises(ValueError, match="more than 2 rows"):
        local_frame(spark.table("polled"), most=2)


def lake(spark, bus, tmp_path, **options):
    measured = parse_messages(replay_stream(spark, bus.path))
    start_bronze(
        measured, str(tmp_path / "lake"), str(tmp_path / "lake-checkpoint"), NOW, **options
    ).awaitTermination()
    return bronze_table(spark, str(tmp_path / "lake"))


@pytest.mark.parametrize("files", [None, 2])
def test_bronze_keeps_every_message_in_folders(spark, bus, tmp_path, files):
    bus.send([envelope(0), envelope(86400, sensor="007"), "not json", None])
    rows = lake(spark, bus, tmp_path, files_per_folder=files)
    assert rows.count() == 4
    assert {p.name for p in (tmp_path / "lake").glob("eventDate=*/sensorType=*")} == {
        "sensorType=barometer", "sensorType=007", "sensorType=__HIVE_DEFAULT_PARTITION__",
    }
    assert {r.sensorType for r in rows.collect()} == {"barometer", "007", None}
    assert [r.jsonValue for r in bad_rows(rows).collect()] == ["not json"]
    assert rows.filter("ingestTime IS NULL").isEmpty()


def test_bronze_reads_only_the_folders_asked_for(spark, bus, tmp_path):
    bus.send([envelope(0), envelope(86400), "bad"])
    rows = lake(spark, bus, tmp_path)
    one_day = rows.filter("eventDate = DATE '2026-05-28' AND sensorType = 'barometer'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(eventDate" in plan and one_day.count() == 1
    bad = bad_rows(rows)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnull(eventDate" in bad


def test_bronze_goes_on_from_its_checkpoint_and_needs_it(spark, bus, tmp_path):
    fill(bus, [[0, 1]])
    assert lake(spark, bus, tmp_path).count() == 2
    fill(bus, [[2]])
    assert lake(spark, bus, tmp_path).count() == 3
    (tmp_path / "lake-checkpoint").rename(tmp_path / "elsewhere")
    with pytest.raises(RuntimeError, match="checkpoint"):
        lake(spark, bus, tmp_path)


def test_outputs_that_are_gone_are_noticed(spark, bus, tmp_path):
    fill(bus, [[0, 1]])
    lake(spark, bus, tmp_path)
    (tmp_path / "lake").rename(tmp_path / "lost")
    with pytest.raises(RuntimeError, match="output"):
        lake(spark, bus, tmp_path)
    root = tmp_path / "live"
    start_live_table(stats_stream(spark, bus), "gone_t", str(root), NOW).awaitTermination()
    (root / "table").rename(tmp_path / "lost-too")
    with pytest.raises(RuntimeError, match="output"):
        start_live_table(stats_stream(spark, bus), "gone_t", str(root), NOW)


def test_a_frame_of_the_live_table_outlives_triggers_and_old_versions_go(spark, bus, tmp_path):
    root = tmp_path / "live"

    def next_version(second, **options):
        fill(bus, [[second]])
        query = start_live_table(stats_stream(spark, bus), "held", str(root), NOW, **options)
        query.awaitTermination()

    next_version(0)
    held = spark.table("held")
    for second in range(1, 11):
        next_version(second)
    assert counts(held) == {-5: 1, 0: 1}
    assert counts(spark.table("held")) == {-5: 5, 0: 10, 5: 6, 10: 1}
    versions = len(list((root / "table").glob("version=*")))
    assert versions >= 11
    next_version(11, keep_seconds=0)
    assert len(list((root / "table").glob("version=*"))) == 3


def test_a_version_without_its_mark_is_not_shown(spark, bus, tmp_path):
    fill(bus, [[0]])
    root = tmp_path / "live"
    start_live_table(stats_stream(spark, bus), "marked", str(root), NOW).awaitTermination()
    shown = counts(spark.table("marked"))
    spark.table("marked").limit(1).write.parquet(str(root / "table" / "version=99"))
    spark.catalog.dropTempView("marked")
    query = start_live_table(stats_stream(spark, bus), "marked", str(root), NOW)
    assert counts(spark.table("marked")) == shown
    query.awaitTermination()


def test_chart_feed_gives_series_and_states(spark, bus, tmp_path):
    fill(bus)
    job = LiveJob(
        "fed", str(tmp_path / "t"), str(tmp_path / "b"), str(tmp_path / "bc"),
        table_trigger=NOW, bronze_trigger=NOW, partitions=2, files_per_folder=1,
    )
    queries = start_live_job(replay_stream(spark, bus.path), job)
    for query in queries:
        query.awaitTermination()
    assert queries[0].recentProgress[0].stateOperators[0].numShufflePartitions == 2
    ((series, states),) = chart_feed(spark, queries, "fed", last_n=3, rounds=5, period=0.01)
    assert list(series["measurementCount"]) == [3, 2, 2]
    assert [state["active"] for state in states] == [False, False]


def test_live_job_runs_two_queries_over_one_source(spark, bus, tmp_path):
    fill(bus)
    job = LiveJob(
        "job_t", str(tmp_path / "t"), str(tmp_path / "b"), str(tmp_path / "bc"),
        table_trigger=NOW, bronze_trigger=NOW,
    )
    for query in start_live_job(replay_stream(spark, bus.path), job):
        query.awaitTermination()
    assert counts(spark.table("job_t")) == COMPLETE
    lake_rows = bronze_table(spark, job.bronze_path)
    assert lake_rows.count() == sum(map(len, BATCHES))


def test_monitor_reports_and_stops_own_queries_only(spark, bus, tmp_path):
    fill(bus, [[0, 1]])
    mine = start_live_table(stats_stream(spark, bus), "mine", str(tmp_path / "m"), Trigger(every=1))
    other = start_live_table(
        stats_stream(spark, bus), "other", str(tmp_path / "o"), Trigger(every=1)
    )
    try:
        mine.processAllAvailable()
        reports = []
        assert run_for(mine, 0.3, period=0.1, report=reports.append)
        assert reports and all(r["active"] and r["exception"] is None for r in reports)
        rows = {r.name: r for r in status_table(spark, [mine, other]).collect()}
        assert rows["mine"].active and rows["mine"].batch_id is not None
        assert stop_named(spark, "mine") == ["mine"]
        assert not mine.isActive and other.isActive
        assert stop_named(spark, "mine") == []
    finally:
        stop_all([mine, other])
    assert not query_status(other)["active"]


def test_run_for_ends_early_and_shows_the_error(spark, bus, tmp_path):
    fill(bus, [[0]])
    done = start_live_table(stats_stream(spark, bus), "ends", str(tmp_path / "e"), NOW)
    assert run_for(done, 60, period=30) is False

    def fail(batch, batch_id):
        raise ValueError("store is away")

    broken = (
        stats_stream(spark, bus).writeStream.foreachBatch(fail).outputMode("update")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    with pytest.raises(Exception, match="store is away"):
        run_for(broken, 60, period=30)
    assert "store is away" in query_status(broken)["exception"]


def test_a_table_of_one_file_or_many_streams_alike(spark, tmp_path):
    rows = spark.range(100).withColumn("v", F.col("id") * 2)
    rows.repartition(3).write.parquet(str(tmp_path / "many.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    (part,) = (tmp_path / "one").glob("part-*.parquet")
    (tmp_path / "single.parquet").write_bytes(part.read_bytes())
    for name in ("many", "single"):
        query = (
            table_stream(spark, str(tmp_path / f"{name}.parquet"))
            .writeStream.format("memory").queryName(name)
            .option("checkpointLocation", str(tmp_path / f"c-{name}"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        assert spark.table(name).agg(F.sum("v")).first()[0] == 9900


def test_bus_options_and_missing_connector(spark):
    bus = BusOptions("host:1", "t", "latest", 5000, 64, {"failOnDataLoss": "false"})
    assert bus_reader_options(bus) == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "t",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "5000",
        "minPartitions": "64",
        "failOnDataLoss": "false",
    }
    assert "minPartitions" not in bus_reader_options(BusOptions("host:1", "t"))
    with pytest.raises(RuntimeError, match="connector"):
        bus_stream(spark, BusOptions("host:1", "t"))
    with pytest.raises(RuntimeError, match="connector"):
        keyed = spark.sql("SELECT CAST('k' AS binary) AS key, CAST('v' AS binary) AS value")
        publish_messages(keyed, BusOptions("host:1", "t"))
    with pytest.raises(ValueError):
        bus_stream(spark, BusOptions("host:1", "t", "yesterday"))


def test_session_is_pinned_to_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Zurich")
    session = build_session(shuffle_partitions=4)
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert session.conf.get("spark.sql.shuffle.partitions") == "4"
    spark.conf.set("spark.sql.session.timeZone", "Europe/Zurich")
    pin_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_session_helpers(spark):
    assert health_check(spark).collect() == [(1,)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with scoped_conf(spark, spark__sql__shuffle__partitions="3", spark__barograph__x="1"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.barograph.x", None) is None
