"""Window statistics against brute force, and their edge cases."""

from __future__ import annotations

import math
import statistics
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph.operators.cache import cache_rows
from barograph.operators.windows import window_stats
from barograph.schema import CACHE
from barograph.settings import WindowSpec

ROWS = "second bigint, walkId string, deviceId string, sensorType string, pressureHpa double"


def measured(spark, rows):
    frame = spark.createDataFrame([(s, w, "d", "b", p) for s, w, p in rows], ROWS)
    return frame.withColumn("eventTime", F.timestamp_seconds("second"))


def results(stats):
    rows = stats.select(
        F.unix_seconds("windowStart").alias("start"), F.unix_seconds("windowEnd").alias("end"), "*"
    ).collect()
    return {(r.start, r.walkId): r for r in rows}


def brute_force(rows, size, slide):
    groups = defaultdict(list)
    for second, walk, pressure in rows:
        if second is None:
            continue
        start = second - second % slide
        while start > second - size:
            groups[start, walk].append(pressure)
            start -= slide
    return groups


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(-40, 40)),
            st.sampled_from(["a", "b"]),
            st.one_of(st.none(), st.integers(-1000, 1000).map(lambda n: n / 4)),
        ),
        min_size=1,
        max_size=30,
    ),
    shape=st.sampled_from([(10, 5), (10, 10), (12, 4)]),
)
def test_statistics_equal_brute_force(spark, rows, shape):
    size, slide = shape
    spec = WindowSpec(f"{size} seconds", None if size == slide else f"{slide} seconds")
    got = results(window_stats(measured(spark, rows), spec))
    want = brute_force(rows, size, slide)
    assert got.keys() == want.keys()
    for key, pressures in want.items():
        row, known = got[key], [p for p in pressures if p is not None]
        assert row.end - row.start == size
        assert row.measurementCount == len(pressures)
        assert row.minPressureHpa == min(known, default=None)
        assert row.maxPressureHpa == max(known, default=None)
        if known:
            assert math.isclose(row.avgPressureHpa, statistics.fmean(known), abs_tol=1e-9)
        else:
            assert row.avgPressureHpa is None
        if len(known) > 1:
            assert math.isclose(row.stddevPressureHpa, statistics.stdev(known), abs_tol=1e-9)
        else:
            assert row.stddevPressureHpa is None


def test_window_bounds_are_half_open_and_epoch_aligned(spark):
    got = results(window_stats(measured(spark, [(9, "a", 1.0), (10, "a", 3.0)])))
    assert {start: r.measurementCount for (start, _), r in got.items()} == {0: 1, 5: 2, 10: 1}


def test_nan_spoils_mean_and_is_the_greatest(spark):
    got = results(window_stats(measured(spark, [(0, "a", 1.0), (1, "a", math.nan)])))
    row = got[0, "a"]
    assert math.isnan(row.avgPressureHpa) and math.isnan(row.maxPressureHpa)
    assert row.minPressureHpa == 1.0 and row.measurementCount == 2


def test_null_keys_form_a_group(spark):
    rows = measured(spark, [(0, None, 1.0), (1, None, 2.0), (1, "a", 2.0)])
    assert results(window_stats(rows))[0, None].measurementCount == 2


def test_no_keys_gives_one_row_per_window(spark):
    stats = window_stats(measured(spark, [(0, "a", 1.0), (1, "b", 2.0)]), keys=())
    assert [r.measurementCount for r in stats.collect()] == [2, 2]
    assert stats.columns[:3] == ["windowStart", "windowEnd", "measurementCount"]


def test_cache_layout(spark):
    rows = cache_rows(window_stats(measured(spark, [(0, "a", 1.0)])))
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in CACHE]
    assert rows.filter("updated_at IS NULL").isEmpty()
    assert isinstance(rows.schema["measurement_count"].dataType, T.LongType)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_plan_aggregates_before_the_one_shuffle(spark):
    plan = plan_of(window_stats(measured(spark, [(0, "a", 1.0)])))
    assert plan.count("Exchange") == 1
    assert plan.index("partial_stddev") > plan.index("Exchange")
    assert "Sort" not in plan and "Python" not in plan and "EventTimeWatermark" not in plan


def test_a_hot_walk_reaches_the_shuffle_as_one_row_per_task_and_window(spark):
    """A third of the rows and more share one window and key."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("w"), F.col("id")))
    rows = spark.range(0, 30_000, numPartitions=6).select(
        hot.alias("walkId"), F.lit("d").alias("deviceId"), F.lit("b").alias("sensorType"),
        F.timestamp_seconds(F.lit(3)).alias("eventTime"), F.lit(1.0).alias("pressureHpa"),
    )
    stats = window_stats(rows, WindowSpec("10 seconds", None))
    assert stats.filter("walkId = 'hot'").first().measurementCount == 10_000
    frame = stats.filter("walkId = 'hot'")
    frame.collect()
    execution = frame._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in execution


@pytest.mark.parametrize("slide", ["5 seconds", None])
def test_empty_input(spark, slide):
    assert window_stats(measured(spark, [(None, "a", 1.0)]), WindowSpec(slide=slide)).isEmpty()
