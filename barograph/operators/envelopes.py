"""Measurements to keyed JSON messages and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.functions.payloads import (
    decode_json,
    json_text,
    leaf_columns,
    pruned,
    text_of,
    utf8,
)
from barograph.functions.times import event_time
from barograph.schema import ENVELOPE


def as_column(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def to_envelopes(
    log: DataFrame,
    user: Column | str,
    device: Column | str,
    walk: Column | str,
    sensor: Column | str,
    base_epoch: Column | float,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rows of ``timeSeconds, pressureHpa`` as ``key`` (the walk) and JSON ``value``.

    The send time in the envelope is ``base_epoch + timeSeconds``: the same log
    gives the same messages, on however many tasks it is read. ``keep`` carries
    further columns along.
    """
    envelope = F.struct(
        as_column(user).alias("userId"),
        as_column(device).alias("deviceId"),
        as_column(walk).alias("walkId"),
        as_column(sensor).alias("sensorType"),
        (as_column(base_epoch) + F.col("timeSeconds")).alias("timestamp"),
        F.struct("timeSeconds", "pressureHpa").alias("data"),
    )
    return log.select(
        *keep,
        utf8(as_column(walk)).alias("key"),
        utf8(json_text(envelope)).alias("value"),
    )


def as_bus_rows(
    keyed: DataFrame, topic: str, offset: Column | None = None, sent: Column | None = None
) -> DataFrame:
    """Keyed messages with the columns a bus adds when it is read.

    Without an ``offset`` column rows are numbered per input task, which needs no
    shuffle; numbers are unique and rise within a task.
    """
    return keyed.select(
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        (F.monotonically_increasing_id() if offset is None else offset).alias("offset"),
        (F.current_timestamp() if sent is None else sent).alias("timestamp"),
        "key",
        "value",
    )


MEASURED = (
    "userId", "deviceId", "walkId", "sensorType", "eventTime", "timeSeconds", "pressureHpa",
)
#: What window statistics need of a message.
FOR_STATS = ("deviceId", "walkId", "sensorType", "eventTime", "pressureHpa")


def parse_messages(
    messages: DataFrame, precision: str = "seconds", wanted: Sequence[str] = MEASURED
) -> DataFrame:
    """Bus rows as typed measurements, one row per message.

    Nothing is dropped: a message that cannot be parsed keeps its text in
    ``jsonValue`` and has NULL measurements. Fields that are not ``wanted`` are
    not parsed.

    The JSON is unpacked with ``inline``, not with field accesses on a struct
    column: filters on fields, such as the one a time window puts on its time,
    stay above it, where otherwise each would be pushed below and parse the JSON
    of every row again.
    """
    raw = messages.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafkaTimestamp"),
        text_of(F.col("key")).alias("messageKey"),
        text_of(F.col("value")).alias("jsonValue"),
    )
    needed = {"timestamp" if name == "eventTime" else name for name in wanted}
    own = pruned(ENVELOPE, needed)
    unpacked = raw.select("*", F.inline(F.array(decode_json(F.col("jsonValue"), own))))
    fields = leaf_columns(own)
    if "timestamp" in fields:
        fields["eventTime"] = event_time(fields["timestamp"], precision)
    return unpacked.select(
        *raw.columns, *[fields[name].alias(name) for name in MEASURED if name in wanted]
    )
