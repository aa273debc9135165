"""Text scans and counts, and the CSV sensor log."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barograph.functions.text import BLANKS
from barograph.operators.envelopes import parse_messages
from barograph.operators.reports import first_row
from barograph.operators.textstats import (
    column_totals,
    line_pairs,
    lines_of,
    sum_by_key,
    text_totals,
)
from barograph.plans.jobs import count_text, send_sensor_log
from barograph.settings import BusOptions
from barograph.sources.files import sensor_log, text_lines
from barograph.sources.messages import replay_batch

TEXT = "Ein Satz.\n\n  zwei   Wörter \r\nmit\xa0Abstand\reins 🙂🙂\n"


def as_dict(rows):
    return {r.key: r.total for r in rows.collect()}


def test_counts_of_a_text_file(spark, tmp_path):
    (tmp_path / "t.txt").write_bytes(TEXT.encode())
    lines = ["Ein Satz.", "", "  zwei   Wörter ", "mit\xa0Abstand", "eins 🙂🙂"]
    scanned = text_lines(spark, str(tmp_path / "t.txt"))
    assert [r.value for r in scanned.collect()] == lines
    assert first_row(scanned).value == "Ein Satz."
    want = {
        "chars": sum(map(len, lines)),
        "words": sum(len(line.split()) for line in lines),
        "lines": len(lines),
    }
    assert as_dict(count_text(spark, str(tmp_path / "t.txt"))) == want


def test_no_lines_give_no_keys(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    scanned = text_lines(spark, str(tmp_path / "empty.txt"))
    assert as_dict(text_totals(scanned)) == {} == as_dict(sum_by_key(line_pairs(scanned)))


def test_blanks_are_the_white_space_of_unicode():
    assert set(BLANKS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.text(
            st.one_of(st.sampled_from(BLANKS + "ab.é🙂"), st.characters(exclude_categories=["Cs"])),
            max_size=25,
        ),
        min_size=1,
        max_size=8,
    )
)
def test_counts_equal_plain_python(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    want = {
        "chars": sum(map(len, texts)),
        "words": sum(len(t.split()) for t in texts),
        "lines": len(texts),
    }
    assert as_dict(text_totals(frame)) == want
    assert as_dict(sum_by_key(line_pairs(frame))) == want
    split = text_totals(lines_of(frame, "value"))
    assert as_dict(column_totals(frame, "value")) == as_dict(split)


@pytest.mark.parametrize("text", ["", "\r\r\n\n", "a\r\nb\rc\n", "\n\r\n\r a"])
def test_line_ends_in_whole_texts(spark, text):
    frame = spark.createDataFrame([(text,), (None,)], "value string")
    split = text_totals(lines_of(frame, "value"))
    assert as_dict(column_totals(frame, "value")) == as_dict(split)


def test_lines_of_a_column(spark):
    frame = spark.createDataFrame([("a\n\nb\r\nc\rd",), ("",), (None,)], "text string")
    assert [r.value for r in lines_of(frame, "text").collect()] == ["a", "", "b", "c", "d", ""]


def test_shuffle_carries_three_rows_per_task_at_most(spark):
    frame = spark.createDataFrame([("a b",)] * 9, "value string")
    plan = sum_by_key(line_pairs(frame))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and plan.count("Exchange") == 1 and "Python" not in plan


LOG = 'Time (s),X (hPa)\n0.0,970.25\n1.5,9.7E2\n2.25,971\n'


@pytest.mark.parametrize("header", ['Time (s),X (hPa)', '"Time (s)","X (hPa)"'])
@pytest.mark.parametrize("mark", ["", "\ufeff"])
def test_sensor_log(spark, tmp_path, header, mark):
    path = tmp_path / "log.csv"
    path.write_text(mark + LOG.replace("Time (s),X (hPa)", header), encoding="utf-8")
    rows = sensor_log(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [(0.0, 970.25), (1.5, 970.0), (2.25, 971.0)]


def test_a_cell_that_is_no_number(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text(LOG + "3.0,oops\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        sensor_log(spark, str(path)).collect()
    kept = sensor_log(spark, str(path), corrupt_column="raw").collect()
    assert [r.pressureHpa for r in kept] == [970.25, 970.0, 971.0, None]
    assert [r.raw for r in kept] == [None, None, None, "3.0,oops"]
    permissive = sensor_log(spark, str(path), mode="PERMISSIVE").collect()
    assert permissive[3].pressureHpa is None and permissive[3].timeSeconds == 3.0


def test_log_to_replay_messages(spark, tmp_path):
    (tmp_path / "log.csv").write_text(LOG)
    bus = str(tmp_path / "bus")
    args = (spark, str(tmp_path / "log.csv"), bus, "u", "d", "w", "barometer", 1.78e9, "own.topic")
    send_sensor_log(*args)
    rows = parse_messages(replay_batch(spark, bus)).orderBy("timeSeconds")
    shown = rows.select("walkId", "pressureHpa", F.unix_seconds("eventTime")).collect()
    assert [tuple(r) for r in shown] == [
        ("w", 970.25, 1780000000), ("w", 970.0, 1780000001), ("w", 971.0, 1780000002),
    ]
    with pytest.raises(RuntimeError, match="connector"):
        send_sensor_log(*args[:2], None, *args[3:], bus=BusOptions("host:1", "own.topic"))
