"""Session settings and checks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "barograph",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session pinned to UTC, with adaptive execution on.

    ``shuffle_partitions`` is also the width of the state of a stream, which its
    checkpoint then fixes: choose it for the target load before the first start.
    Batch shuffles start from it and are coalesced or split at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**settings, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Day bounds and second-truncation must not depend on a local zone or its DST."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def scoped_conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Set SQL settings for a block and put the old ones back.

    A stream copies the session settings when it starts, so settings meant for
    one stream need to hold only around ``start()``. Keys use ``__`` for ``.``.
    """
    named = {key.replace("__", "."): value for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in named}
    try:
        for key, value in named.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def task_count(spark: SparkSession) -> int:
    """Tasks that a shuffle starts from."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def health_check(spark: SparkSession) -> DataFrame:
    """One literal row, to see that the session can run a query."""
    return spark.sql("SELECT 1 AS ok")
