"""One stream, one parse, two stores: the raw lake and window statistics.

Layout under one root folder::

    checkpoint/                     of the stream
    lake/batch_id=N/eventDate=D/    rows of micro-batch N, as parsed
    panes/batch_id=N/               partial statistics of the batch, per pane and key
    committed/N                     both stores hold the batches up to N

The stream itself is stateless. A batch's messages are parsed once, into the
lake; its panes are made from the lake's files of the batch, by the few columns
they need. Both stores are written under the batch's number, so a batch that is
run again replaces what it wrote, and readers of either store go no further
than the mark that follows both: they always see the same messages.
Panes of several batches merge when they are read, so late rows always count
and no state is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barograph.operators.bronze import bronze_rows
from barograph.operators.envelopes import parse_messages
from barograph.operators.panes import MOMENTS, pane_rows, pane_windows
from barograph.schema import BRONZE, GROUP_KEYS, layout
from barograph.settings import Trigger, WindowSpec
from barograph.streaming.health import observed
from barograph.streaming.starting import require_checkpoint, start_stream
from barograph.workspace import LastDone

BATCH = T.StructField("batch_id", T.LongType())
LAKE = T.StructType([*BRONZE.fields, BATCH])
PANES = T.StructType([
    *layout({"paneStart": "timestamp", **dict.fromkeys(GROUP_KEYS, "string")}).fields,
    *layout({name: "bigint" if name.endswith("Count") else "double" for name in MOMENTS}).fields,
    BATCH,
])


class LakeAndWindows:
    def __init__(self, spark: SparkSession, root: str, windows: WindowSpec = WindowSpec()):
        self.spark = spark
        self.windows = windows
        self.checkpoint = f"{root}/checkpoint"
        self.lake_path = f"{root}/lake"
        self.panes_path = f"{root}/panes"
        self.done = LastDone(spark, f"{root}/committed")

    def store_rows(self, messages: DataFrame, batch_id: int) -> None:
        """Parse a batch's messages into its folder of the lake, replacing what is there."""
        rows = bronze_rows(observed(parse_messages(messages)))
        rows.write.mode("overwrite").partitionBy("eventDate").parquet(self._batch(self.lake_path, batch_id))

    def store_panes(self, batch_id: int) -> None:
        """Partial statistics of a batch, from its rows in the lake."""
        rows = self.spark.read.schema(BRONZE).parquet(self._batch(self.lake_path, batch_id))
        panes = pane_rows(rows, self.windows)
        panes.write.mode("overwrite").parquet(self._batch(self.panes_path, batch_id))

    def store(self, messages: DataFrame, batch_id: int) -> None:
        self.store_rows(messages, batch_id)
        self.store_panes(batch_id)
        self.done.mark(max(batch_id, self.done.last() or 0))

    @staticmethod
    def _batch(path: str, batch_id: int) -> str:
        return f"{path}/batch_id={batch_id}"

    def start(
        self,
        messages: DataFrame,
        trigger: Trigger = Trigger(every=10),
        name: str | None = None,
        partitions: int | None = None,
    ) -> StreamingQuery:
        """Keep both stores up to date with a stream of bus messages."""
        require_checkpoint(self.spark, self.checkpoint, self.lake_path)
        writer = messages.writeStream.foreachBatch(self.store).outputMode("append")
        return start_stream(self.spark, writer, self.checkpoint, trigger, name, partitions)

    def _committed(self, path: str, schema: T.StructType) -> DataFrame:
        last = self.done.last()
        if last is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).filter(F.col(BATCH.name) <= last)

    def lake(self) -> DataFrame:
        """All rows of the batches that both stores hold."""
        return self._committed(self.lake_path, LAKE)

    def stats(self, windows: WindowSpec | None = None) -> DataFrame:
        """Window statistics of the same rows.

        ``windows`` may be any whose size and slide are whole panes of those that
        the store was filled for: the width can change without reading the rows again.
        """
        return pane_windows(self._committed(self.panes_path, PANES), windows or self.windows)
