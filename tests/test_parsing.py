"""Envelopes, message parsing and time functions."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from conftest import START, envelope
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from barograph.functions.times import epoch_text, event_time, parse_day, year_bounds
from barograph.operators.envelopes import (
    FOR_STATS,
    as_bus_rows,
    parse_messages,
    to_envelopes,
)
from barograph.sources.messages import replay_batch

UTC = dt.timezone.utc


def parsed(spark, bus, *values):
    bus.send(list(values))
    return parse_messages(replay_batch(spark, bus.path)).orderBy("offset").collect()


def test_complete_envelope(spark, bus):
    (row,) = parsed(spark, bus, envelope(0.75, 970.5, elapsed=1.25))
    assert row.messageKey == "w1" and row.walkId == "w1" and row.userId == "walker-7"
    assert row.deviceId == "logger-a" and row.sensorType == "barometer"
    assert row.timeSeconds == 1.25 and row.pressureHpa == 970.5
    assert spark.range(1).select(
        event_time(F.lit(START + 0.75)).cast("string").alias("t")
    ).first().t == "2026-05-28 20:26:40"


@pytest.mark.parametrize(
    "text",
    ["not json", '{"userId": "u', "[]", "null", '[{"userId": "u"}, {"userId": "v"}]', "", None],
)
def test_malformed_messages_keep_their_row_and_text(spark, bus, text):
    first, second = parsed(spark, bus, text, envelope(0))
    assert first.jsonValue == text
    fields = ("userId", "walkId", "sensorType", "eventTime", "timeSeconds", "pressureHpa")
    assert all(first[name] is None for name in fields)
    assert second.walkId == "w1"


def test_bad_fields_spoil_only_themselves(spark, bus):
    good = envelope(0, 970.0)
    rows = parsed(
        spark,
        bus,
        good.replace(f'"timestamp": {START}', '"timestamp": "x"'),
        good.replace("970.0", '"970.5"'),
        good.replace('"walker-7"', "7"),
        good[: good.index('"data"')] + '"data": 5}',
        good.replace('"userId"', '"userid"').replace("{", '{"more": [1], ', 1),
        good.replace("970.0", "NaN"),
    )
    assert rows[0].eventTime is None and rows[0].pressureHpa == 970.0
    assert rows[1].pressureHpa is None and rows[1].walkId == "w1"
    assert rows[2].userId == "7"
    assert rows[3].pressureHpa is None and rows[3].timeSeconds is None and rows[3].eventTime
    assert rows[4].userId is None and rows[4].walkId == "w1"
    assert math.isnan(rows[5].pressureHpa)


@pytest.mark.parametrize("value", ["NaN", "Infinity", "1e30", "1e18", "-1e30", "253402300800"])
def test_impossible_times_are_null_and_raise_nothing(spark, value):
    epoch = F.lit(value).cast("double")
    row = spark.range(1).select(
        event_time(epoch).alias("s"), event_time(epoch, "micros").alias("m"),
        epoch_text(epoch).alias("t"),
    ).first()
    assert row == (None, None, None)


def test_seconds_are_cut_toward_zero_and_micros_kept(spark):
    def shown(epoch, precision):
        return spark.range(1).select(
            event_time(F.lit(epoch), precision).cast("string").alias("t")
        ).first().t

    assert shown(-1.5, "seconds") == "1969-12-31 23:59:59"
    assert shown(1.75, "seconds") == "1970-01-01 00:00:01"
    assert shown(1704067207.179575, "micros") == "2024-01-01 00:00:07.179575"
    with pytest.raises(ValueError):
        event_time(F.lit(1.0), "hours")


def test_text_form_reads_back_to_the_same_time(spark):
    epoch = F.col("id") * 86399.5
    rows = spark.range(0, 2000).select(
        event_time(epoch).alias("direct"), F.to_timestamp(epoch_text(epoch)).alias("text")
    )
    assert rows.filter(~F.col("direct").eqNullSafe(F.col("text"))).isEmpty()


def test_two_instants_in_a_dst_overlap_stay_apart(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Zurich")
    try:
        both = spark.range(1).select(
            event_time(F.lit(1761438600.0)).alias("a"), event_time(F.lit(1761442200.0)).alias("b")
        )
        assert both.select(F.unix_seconds("b") - F.unix_seconds("a")).first()[0] == 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_day_and_year_are_checked_before_any_job():
    assert parse_day("2026-05-31") == dt.date(2026, 5, 31)
    assert parse_day(dt.datetime(2026, 5, 31, 7)) == dt.date(2026, 5, 31)
    assert year_bounds(2026) == (dt.date(2026, 1, 1), dt.date(2027, 1, 1))
    for bad in ("bad-string", "2026-02-30", ""):
        with pytest.raises(ValueError):
            parse_day(bad)
    with pytest.raises(ValueError):
        year_bounds(0)


def test_envelopes_survive_the_round_trip(spark):
    log = spark.createDataFrame(
        [(0.0, 970.25), (1.5, None), (2.25, 1e-7)], "timeSeconds double, pressureHpa double"
    )
    keyed = to_envelopes(log, "u", "d", "wälk", "barometer", float(START))
    assert keyed.columns == ["key", "value"]
    rows = parse_messages(as_bus_rows(keyed, "t")).orderBy("timeSeconds").collect()
    assert [(r.timeSeconds, r.pressureHpa) for r in rows] == [
        (0.0, 970.25), (1.5, None), (2.25, 1e-7),
    ]
    assert {r.messageKey for r in rows} == {"wälk"}
    seconds = parse_messages(as_bus_rows(keyed, "t")).select(F.unix_seconds("eventTime"))
    assert sorted(r[0] for r in seconds.collect()) == [START, START + 1, START + 2]
    again = to_envelopes(log, "u", "d", "wälk", "barometer", float(START))
    assert keyed.exceptAll(again).isEmpty()


def test_json_is_parsed_once_under_a_filter(spark, bus):
    bus.send([envelope(0)])
    rows = parse_messages(replay_batch(spark, bus.path)).filter("eventTime IS NOT NULL")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_missing_column_is_an_analysis_error(spark):
    with pytest.raises((AnalysisException, PySparkException)):
        parse_messages(spark.range(1)).collect()


def test_only_wanted_fields_are_parsed(spark, bus):
    bus.send([envelope(0), "bad", None])
    rows = replay_batch(spark, bus.path)
    lean = parse_messages(rows, wanted=FOR_STATS)
    full = parse_messages(rows)
    assert [c for c in full.columns if c not in lean.columns] == ["userId", "timeSeconds"]
    assert full.select(*lean.columns).exceptAll(lean).isEmpty()
    plan = lean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1 and "userId" not in plan and "timeSeconds" not in plan
