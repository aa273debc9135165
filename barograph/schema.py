"""Declared layouts: message envelope, bus rows, measurements, bronze, cache.

Column names, nesting and types below are fixed values of the data model.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def layout(columns: dict[str, str | T.DataType]) -> T.StructType:
    """A struct of nullable columns. Needs no session, unlike parsing a DDL text."""
    return T.StructType(
        [
            T.StructField(name, kind if isinstance(kind, T.DataType) else TYPES[kind])
            for name, kind in columns.items()
        ]
    )


ENVELOPE = layout({
    "userId": "string",
    "deviceId": "string",
    "walkId": "string",
    "sensorType": "string",
    "timestamp": "double",
    "data": layout({"timeSeconds": "double", "pressureHpa": "double"}),
})

MESSAGE = layout({
    "topic": "string",
    "partition": "int",
    "offset": "bigint",
    "timestamp": "timestamp",
    "key": "binary",
    "value": "binary",
})

SENSOR_LOG = layout({"Time (s)": "double", "X (hPa)": "double"})

BRONZE = layout({
    "topic": "string",
    "partition": "int",
    "offset": "bigint",
    "messageKey": "string",
    "jsonValue": "string",
    "userId": "string",
    "deviceId": "string",
    "walkId": "string",
    "sensorType": "string",
    "eventTime": "timestamp",
    "kafkaTimestamp": "timestamp",
    "ingestTime": "timestamp",
    "timeSeconds": "double",
    "pressureHpa": "double",
    "eventDate": "date",
})
BRONZE_PARTITIONS = ("eventDate", "sensorType")

GROUP_KEYS = ("walkId", "deviceId", "sensorType")

CACHE = layout({
    "walk_id": "string",
    "device_id": "string",
    "sensor_type": "string",
    "window_start": "timestamp",
    "window_end": "timestamp",
    "measurement_count": "bigint",
    "avg_pressure_hpa": "double",
    "min_pressure_hpa": "double",
    "max_pressure_hpa": "double",
    "stddev_pressure_hpa": "double",
    "updated_at": "timestamp",
})
CACHE_KEY = ("walk_id", "device_id", "sensor_type", "window_start", "window_end")


def snake_case(name: str) -> str:
    """``avgPressureHpa`` -> ``avg_pressure_hpa``."""
    return re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()
