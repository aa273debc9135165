"""Job parameters. All jobs take these as arguments; nothing is read from globals."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class WindowSpec:
    """Event-time window. ``slide=None`` makes it tumbling."""

    size: str = "10 seconds"
    slide: str | None = "5 seconds"
    watermark: str = "1 minute"


@dataclass(frozen=True)
class BusOptions:
    """Where and how to read a message bus topic.

    Messages are keyed by walk, so one busy walk fills one topic partition.
    ``min_partitions`` lets Spark split such a partition over several tasks, and
    ``max_offsets_per_trigger`` bounds what one micro-batch takes in.
    """

    servers: str
    topic: str
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    extra: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class CacheFilter:
    """What to read from the result cache."""

    walk_id: str
    sensor_type: str
    year: int


@dataclass(frozen=True)
class Trigger:
    """``every`` seconds of processing time, or ``None``: take what is there and stop."""

    every: int | None = None

    def options(self) -> dict:
        if self.every is None:
            return {"availableNow": True}
        return {"processingTime": f"{self.every} seconds"}
