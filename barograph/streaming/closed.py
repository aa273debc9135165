"""Windows written once, when the watermark has closed them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barograph.schema import CACHE
from barograph.settings import Trigger
from barograph.streaming.starting import require_checkpoint, start_stream
from barograph.operators.cache import cache_rows

CLOSED = T.StructType([*CACHE.fields, T.StructField("window_date", T.DateType())])


def start_closed_windows(
    stats: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger = Trigger(every=10),
    name: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Append each window of a stream of statistics to a table in folders by start date.

    A window is written when the watermark passes its end, and its state is
    dropped: state holds the open windows alone, and no row of the table changes
    afterwards. A late row counts while one of its windows is open and is left
    out of those already written. The file sink's log makes each batch's files
    visible once and together, so restarts repeat nothing.
    """
    require_checkpoint(stats.sparkSession, checkpoint, f"{path}/_spark_metadata")
    rows = cache_rows(stats).withColumn("window_date", F.to_date("window_start"))
    writer = (
        rows.writeStream.format("parquet")
        .option("path", path)
        .partitionBy("window_date")
        .outputMode("append")
    )
    return start_stream(stats.sparkSession, writer, checkpoint, trigger, name, partitions)


def closed_windows(spark: SparkSession, path: str) -> DataFrame:
    """The table of closed windows; filters on ``window_date`` open only its folders."""
    return spark.read.schema(CLOSED).parquet(path)


def open_windows(spark: SparkSession, checkpoint: str, keys: tuple[str, ...]) -> DataFrame:
    """Windows that a stream of ``window_stats`` still holds in state, with what they have so far.

    Read from the checkpoint of a stream that is stopped, by Spark's state data
    source; nothing of the stream runs. The state of a mean is a sum and a
    count, that of a deviation a count, a mean and the squared deviations.
    """
    state = spark.read.format("statestore").load(checkpoint)
    # By position, as some names repeat: count, mean, min, max, deviation as in ``window_stats``.
    buffer = "struct<rows:bigint,total:double,counted:bigint,low:double,high:double,n:double,mean:double,squares:double>"
    value = F.col("value").cast(buffer)
    window, *rest = [F.col("key").getField(field) for field in state.schema["key"].dataType.names]
    n = value.n
    return state.select(
        window.start.alias("windowStart"),
        window.end.alias("windowEnd"),
        *[column.alias(key) for column, key in zip(rest, keys, strict=True)],
        value.rows.alias("measurementCount"),
        F.try_divide(value.total, value.counted).alias("avgPressureHpa"),
        value.low.alias("minPressureHpa"),
        value.high.alias("maxPressureHpa"),
        F.when(n > 1, F.sqrt(value.squares / (n - 1))).alias("stddevPressureHpa"),
    )
