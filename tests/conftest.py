from __future__ import annotations

import datetime as dt
import json
import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from barograph.schema import MESSAGE  # noqa: E402

START = 1780000000  # 2026-05-28T20:26:40Z, a multiple of 5 seconds


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("barograph-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "5000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def envelope(
    second: float, pressure: float | None = 970.0, walk: str = "w1", elapsed: float = 0.0,
    device: str = "logger-a", sensor: str = "barometer",
) -> str:
    return json.dumps({
        "userId": "walker-7",
        "deviceId": device,
        "walkId": walk,
        "sensorType": sensor,
        "timestamp": START + second,
        "data": {"timeSeconds": elapsed, "pressureHpa": pressure},
    })


class Bus:
    """A replay folder filled file by file, each newer than the one before."""

    def __init__(self, spark: SparkSession, folder: Path):
        self.spark, self.folder, self.files, self.sent = spark, folder, 0, 0
        folder.mkdir()

    @property
    def path(self) -> str:
        return str(self.folder)

    def send(self, values: list[str | None], key: str = "w1") -> None:
        rows = []
        for value in values:
            body = None if value is None else bytearray(value.encode())
            at = dt.datetime(2026, 5, 28, 21, tzinfo=dt.timezone.utc)
            rows.append(("t", 0, self.sent, at, bytearray(key.encode()), body))
            self.sent += 1
        staged = self.folder.with_name(f"{self.folder.name}-staged-{self.files}")
        frame = self.spark.createDataFrame(rows, MESSAGE).coalesce(1)
        frame.write.parquet(str(staged))
        (part,) = staged.glob("part-*.parquet")
        target = self.folder / f"{self.files:04d}.parquet"
        target.write_bytes(part.read_bytes())
        os.utime(target, (START + self.files, START + self.files))
        self.files += 1


@pytest.fixture
def bus(spark, tmp_path):
    return Bus(spark, tmp_path / "bus")
