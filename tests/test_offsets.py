"""Offsets of bus partitions."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from barograph.operators.offsets import with_offsets
from barograph.plans.jobs import send_sensor_log
from barograph.schema import MESSAGE
from barograph.sources.messages import replay_batch


def keyed(spark, rows):
    frame = spark.createDataFrame(rows, "key string, value string, at long")
    return frame.withColumns({"key": F.encode("key", "UTF-8"), "value": F.encode("value", "UTF-8")})


def partition_of(key, partitions):
    if key is None:
        return 0
    return int(hashlib.md5(key.encode()).hexdigest()[:8], 16) % partitions


@pytest.mark.parametrize("partitions", [1, 5])
def test_offsets_have_no_gaps_and_follow_the_order(spark, partitions):
    # One key with half of the rows, null keys and values, ties in time, repeated rows, null times.
    rows = [("hot" if n % 2 else f"w{n % 9}", f"v{n}", n % 50) for n in range(4000)]
    rows += [(None, None, None)] * 30 + [("hot", "same", 7)] * 200 + [("", "", 3)]
    table = keyed(spark, rows).repartition(6)
    found = with_offsets(table, "t", partitions, ("at",), F.timestamp_seconds("at"))
    assert found.schema == MESSAGE or [f.name for f in found.schema] == MESSAGE.fieldNames()
    got = found.collect()
    text = lambda x: None if x is None else x.decode()
    assert Counter((text(r.key), text(r.value)) for r in got) == Counter((k, v) for k, v, _ in rows)
    per = defaultdict(list)
    for row in got:
        assert row.partition == partition_of(text(row.key), partitions) and row.topic == "t"
        per[row.partition].append((row.offset, row.timestamp))
    for numbered in per.values():
        numbered.sort(key=lambda x: x[0])
        assert [n for n, _ in numbered] == list(range(len(numbered)))
        times = [at for _, at in numbered if at is not None]
        assert times == sorted(times)


def test_a_hot_key_is_spread_over_tasks(spark, tmp_path):
    spark.range(200_000).selectExpr(
        "encode('hot', 'UTF-8') AS key", "encode(repeat('x', 50), 'UTF-8') AS value", "CAST(1 AS long) AS at"
    ).write.parquet(str(tmp_path / "rows"))
    table = spark.read.parquet(str(tmp_path / "rows"))
    # Partitions so small that adaptive execution joins none.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = with_offsets(table, "t", 4, ("at",))
        sizes = [pq.read_metadata(x.removeprefix("file:")).num_rows for x in found.inputFiles()]
        assert found.agg(F.max("`offset`") + 1, F.countDistinct("`offset`")).first()[:] == (200_000, 200_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 200_000 and max(sizes) < 100_000


def test_nothing_has_no_offsets(spark):
    assert with_offsets(keyed(spark, []), "t", 3, ("at",)).collect() == []


def test_a_log_is_sent_by_partition(spark, tmp_path):
    (tmp_path / "log.csv").write_text("Time (s),X (hPa)\n" + "".join(f"{n / 10},{970 + n}\n" for n in range(90)))
    send_sensor_log(spark, str(tmp_path / "log.csv"), str(tmp_path / "bus"), "u", "d", "w", "b", 1e9, "t",
                    partitions=3)
    rows = replay_batch(spark, str(tmp_path / "bus")).collect()
    assert {r.partition for r in rows} == {partition_of("w", 3)}
    values = [r.value for r in sorted(rows, key=lambda r: r.offset)]
    assert sorted(r.offset for r in rows) == list(range(90))
    assert [f'"timeSeconds":{n / 10}'.encode() in value for n, value in enumerate(values)] == [True] * 90
