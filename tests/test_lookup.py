"""Look-ups by walk, the cache's manifest, logs of many walks."""

from __future__ import annotations

from pathlib import Path

import pytest
from conftest import START
from pyspark.sql import functions as F
from test_panes import executed

from barograph.operators.envelopes import as_bus_rows, parse_messages, to_envelopes
from barograph.plans.catalogue import csv_many_logs
from barograph.schema import CACHE
from barograph.settings import CacheFilter
from barograph.sources.files import sensor_logs
from barograph.streaming.resultcache import ResultCache
from barograph.workspace import listed, read_text, write_text

HOUR = 3600


def batch(spark, walks, hour=0, value=1.0):
    """Cache rows of one window per walk."""
    start = F.timestamp_seconds(F.lit(START - START % HOUR + hour * HOUR))
    shown = {
        "walk_id": F.col("walk"), "device_id": F.lit("d"), "sensor_type": F.lit("b"),
        "window_start": start, "window_end": start + F.expr("INTERVAL 1 HOUR"),
        "measurement_count": F.lit(1).cast("bigint"), "updated_at": F.current_timestamp(),
    }
    frame = spark.createDataFrame([(w,) for w in walks], "walk string")
    return frame.select(*[
        shown.get(name, F.lit(value).cast("double")).alias(name) for name in CACHE.fieldNames()
    ])


def scanned(frame):
    return sum(node.metrics().apply("numOutputRows").value() for name, node in executed(frame)
               if name.startswith("Scan parquet"))


@pytest.mark.parametrize("compacted", [False, True])
def test_row_groups_without_the_walk_are_not_read(spark, tmp_path, compacted):
    cache = ResultCache(spark, str(tmp_path))
    # Too many walks for a dictionary, so that only the filter can tell.
    walks = [f"walk-{n * 2:07d}-{'x' * 40}" for n in range(60_000)]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        cache.upsert(batch(spark, walks).coalesce(1), 0)
        if compacted:
            cache.compact()
            cache.drop_compacted()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    present, absent = walks[31_000], f"walk-{62_001:07d}-{'x' * 40}"
    assert scanned(cache.read(CacheFilter(present, "b", 2026))) > 0
    assert cache.read(CacheFilter(present, "b", 2026)).count() == 1
    # Between the least and the greatest walk of every file.
    assert scanned(cache.read(CacheFilter(absent, "b", 2026))) == 0


def test_one_manifest_tells_all_bases(spark, tmp_path):
    cache = ResultCache(spark, str(tmp_path))
    assert cache.bases() == {} and cache.compacted_through() is None
    for number in range(5):
        cache.upsert(batch(spark, ["a", "b"], hour=24 * number, value=float(number)), number)
        cache.compact()
    # Each compaction's manifest replaces the one before the last.
    assert [x.rpartition("/")[2] for x in listed(spark, f"{cache.manifest}/*")] == ["3", "4"]
    assert sorted(cache.bases().values()) == [0, 1, 2, 3, 4] and cache.compacted_through() == 4
    cache.compact()  # nothing changed: no new one
    assert len(listed(spark, f"{cache.manifest}/*")) == 2
    # A half-written one is not seen.
    (tmp_path / "manifest" / "_9-staged").write_text("{")
    assert cache.compacted_through() == 4 and cache.rows().count() == 10


def test_bases_need_no_job(spark, tmp_path):
    cache = ResultCache(spark, str(tmp_path))
    cache.upsert(batch(spark, ["a"]), 0)
    cache.compact()
    spark.sparkContext.setJobGroup("look", "look")
    try:
        assert cache.bases() and cache.rows() is not None
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("look") == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_small_files_replace_each_other(spark, tmp_path):
    path = str(tmp_path / "deep" / "note")
    for text in ("", "one", "zwei ß 漢"):
        write_text(spark, path, text)
        assert read_text(spark, path) == text
    assert len([x for x in (tmp_path / "deep").iterdir() if not x.name.startswith(".")]) == 1


def test_many_logs_in_one_scan(spark, tmp_path):
    head = "﻿Time (s),X (hPa)\n"
    logs = {"a b": 3, "c+d": 2, "hot": 40_000, "50%": 1, "unknown": 2}
    for n, (walk, rows) in enumerate(logs.items()):
        folder = tmp_path / "logs" / f"day{n % 2}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{walk}.csv").write_text(
            head + "".join(f"{k / 4},{900 + k % 7}\n" for k in range(rows)), "utf-8")
    (tmp_path / "logs" / "empty.csv").write_text(head, "utf-8")
    bases = spark.createDataFrame([(w, float(n)) for n, w in enumerate(logs) if w != "unknown"],
                                  "walkId string, baseEpoch double")
    bases.write.parquet(str(tmp_path / "bases"))  # of a size that Spark knows
    bases = spark.read.parquet(str(tmp_path / "bases"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        rows = sensor_logs(spark, str(tmp_path / "logs"), bases)
        hot = rows.filter("walkId = 'hot'").select(F.spark_partition_id().alias("task"))
        assert hot.distinct().count() > 1
        found = rows.groupBy("walkId").agg(F.count("*"), F.min("baseEpoch"), F.sum("timeSeconds")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {tuple(row) for row in found} == {
        (walk, count, None if walk == "unknown" else float(n), sum(k / 4 for k in range(count)))
        for n, (walk, count) in enumerate(logs.items())
    }
    keyed = to_envelopes(rows, "u", "d", F.col("walkId"), "b", F.col("baseEpoch"))
    parsed = parse_messages(as_bus_rows(keyed, "t"))
    assert parsed.filter("eventTime IS NULL").select("walkId").distinct().collect() == [("unknown",)]
    assert parsed.count() == sum(logs.values())


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    walks = 40 * spark.sparkContext.defaultParallelism
    for n in range(walks):
        (tmp_path / "logs" / f"walk={n}").mkdir(parents=True)
        (tmp_path / "logs" / f"walk={n}" / "log.csv").write_text(f"Time (s),X (hPa)\n0.5,{n}\n")
    bases = spark.createDataFrame([(str(n), float(n)) for n in range(walks)], "walkId string, baseEpoch double")
    context = spark.sparkContext
    context.setJobGroup("listing", "listing")
    try:
        rows = sensor_logs(spark, str(tmp_path / "logs"), bases, walk=r"/walk=([^/]+)/")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    tasks = [tracker.getStageInfo(s).numTasks for s in stages]
    assert tasks and max(tasks) <= 4 * context.defaultParallelism
    found = {tuple(row) for row in rows.collect()}
    assert found == {(str(n), float(n), 0.5, float(n)) for n in range(walks)}


def test_many_logs_are_written_by_all_tasks(spark, tmp_path):
    walks = 24
    spark.range(walks * 3).select(
        F.timestamp_seconds(F.lit(START) + F.col("id")).cast("timestamp_ntz").alias("ts"),
        F.pmod("id", F.lit(walks)).alias("user_id"),
        F.col("id").cast("double").alias("value"),
    ).write.parquet(str(tmp_path / "events.parquet"))
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("csv-logs-*"))
    found = csv_many_logs(spark, str(tmp_path))
    assert found.count() == walks * 3
    (own,) = set(shared.glob("csv-logs-*")) - before
    files = list(own.glob("run/logs/walk=*/part-*.csv"))
    # A log per walk, and more than one task has written them.
    assert len(files) == walks and len({file.name[:10] for file in files}) > 1
