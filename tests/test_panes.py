"""Windows made of shared panes equal windows made of rows."""

from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from barograph.operators.panes import MOMENTS, pane_rows, pane_stats, pane_windows, shape_of, span_micros
from barograph.operators.windows import window_stats
from barograph.settings import WindowSpec
from test_windows import brute_force, measured, results

KEYS = ("walkId",)


def close(one, other):
    if one is None or other is None:
        return one is other
    return one == other or (math.isnan(one) and math.isnan(other)) or math.isclose(one, other, rel_tol=1e-9, abs_tol=1e-9)


def same(panes, rows):
    left, right = results(panes), results(rows)
    assert left.keys() == right.keys()
    for key, row in left.items():
        assert row.end == right[key].end and row.measurementCount == right[key].measurementCount
        for name in ("avgPressureHpa", "minPressureHpa", "maxPressureHpa", "stddevPressureHpa"):
            assert close(row[name], right[key][name]), (key, name, row, right[key])


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(-60, 60)),
            st.sampled_from(["a", "b"]),
            st.one_of(st.none(), st.just(math.nan), st.integers(-4000, 4000).map(lambda n: 970 + n / 4)),
        ),
        min_size=1,
        max_size=30,
    ),
    shape=st.sampled_from([(60, 1), (10, 4), (12, 5), (9, 9), (30, 20)]),
)
def test_panes_equal_rows(spark, rows, shape):
    spec = WindowSpec(*[f"{n} seconds" for n in shape])
    table = measured(spark, rows)
    stats = pane_stats(table, spec, KEYS)
    same(stats, window_stats(table, spec, KEYS))
    counts = {key: len(values) for key, values in brute_force(rows, *shape).items()}
    assert {key: row.measurementCount for key, row in results(stats).items()} == counts


def test_values_far_from_zero_keep_their_deviation(spark):
    rows = [(second, "a", 1e6 + second % 7 / 8) for second in range(300)]
    spec = WindowSpec("1 minute", "1 second")
    table = measured(spark, rows)
    same(pane_stats(table, spec, KEYS), window_stats(table, spec, KEYS))


def test_empty_and_single(spark):
    spec = WindowSpec("1 minute", "7 seconds")
    assert pane_stats(measured(spark, []), spec, KEYS).collect() == []
    found = pane_stats(measured(spark, [(3, "a", 970.0), (None, "a", 1.0), (90, "a", None)]), spec, KEYS)
    for row in found.collect():
        assert row.measurementCount == 1 and row.stddevPressureHpa is None


def test_partial_panes_of_batches_merge(spark):
    rows = [(n * 3 % 71, "ab"[n % 2], 950 + n % 13 / 3) for n in range(120)]
    spec = WindowSpec("20 seconds", "8 seconds")
    parts = [pane_rows(measured(spark, rows[k::3]), spec, KEYS) for k in range(3)]
    together = pane_windows(parts[0].unionByName(parts[1]).unionByName(parts[2]), spec, KEYS)
    same(together, window_stats(measured(spark, rows), spec, KEYS))


def executed(frame):
    """The final plan's nodes, after a run, with their metrics."""
    frame.collect()
    nodes = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        nodes.append((name, node))
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(frame._jdf.queryExecution().executedPlan())
    return nodes


def test_rows_are_aggregated_once(spark, tmp_path):
    rows = [(n, "a", 970.0) for n in range(2000)]
    measured(spark, rows).write.parquet(str(tmp_path / "rows"))
    table = spark.read.parquet(str(tmp_path / "rows"))
    nodes = executed(pane_stats(table, WindowSpec("1 hour", "1 minute"), KEYS))
    names = [name for name, _ in nodes]
    first = max(k for k, name in enumerate(names) if name == "HashAggregate")
    below = names[first + 1:]
    assert not any("Expand" in name or "Generate" in name for name in below)
    scanned = sum(node.metrics().apply("numOutputRows").value() for name, node in nodes if "Scan" in name)
    assert scanned == 2000
    made = nodes[first][1].metrics().apply("numOutputRows").value()
    # As many as there are minutes, once per task.
    assert made <= 34 * table.rdd.getNumPartitions()
    dealt = [node for name, node in nodes if name == "Generate"][-1]
    assert dealt.metrics().apply("numOutputRows").value() <= 2 * 34


def test_spans():
    assert span_micros("1 hour 30 minutes") == 5_400_000_000
    assert span_micros("INTERVAL 5 seconds") == 5_000_000 and span_micros("2 weeks") == 14 * 86_400_000_000
    assert shape_of(WindowSpec("3 days", "2 days"))[2] == 86_400_000_000
    for bad in ("1 month", "soon", ""):
        with pytest.raises(ValueError):
            span_micros(bad)
    with pytest.raises(ValueError):
        shape_of(WindowSpec("1 second", "2 seconds"))


def test_panes_hold_the_moments(spark):
    (row,) = pane_rows(measured(spark, [(0, "a", 1.0), (1, "a", 3.0), (2, "a", None)]),
                       WindowSpec("10 seconds", "5 seconds"), KEYS).select(*MOMENTS).collect()
    assert tuple(row) == (3, 2, 4.0, 2.0, 1.0, 3.0)
