"""Result cache: an append-only changelog with a latest-wins view.

Layout under one root folder::

    checkpoint/                            of the stream that fills the cache
    changelog/batch_id=N/window_date=D/    rows changed by micro-batch N
    committed/N                            batch N is all there; readers see up to it
    base/upto=N/window_date=D/             newest rows of a date from batches 0..N
    manifest/N                             of the compaction up to N: per date the base's N

The checkpoint lives beside the changelog because its batch numbers are the
versions: one without the other is of no use.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barograph.functions.times import parse_day, year_bounds
from barograph.operators.cache import cache_rows, latest_wins
from barograph.operators.filters import in_year, on_day, on_sensor, on_walk
from barograph.schema import CACHE, CACHE_KEY
from barograph.settings import CacheFilter, Trigger
from barograph.streaming.starting import require_checkpoint, spread_over_files, start_stream
from barograph.workspace import LastDone, drop_folder, listed, read_text, write_text

DATE = T.StructField("window_date", T.DateType())
STORED = T.StructType([*CACHE.fields, DATE])
LOGGED = T.StructType([*STORED.fields, T.StructField("batch_id", T.LongType())])
BASE = T.StructType([*STORED.fields, T.StructField("upto", T.LongType())])

# The date follows from the window start, so it may join the key; as a key column
# it lets filters on it pass through the view to the folders.
VIEW_KEY = (*CACHE_KEY, DATE.name)
FILE_ORDER = (DATE.name, "sensor_type", "walk_id", "window_start", "device_id")
# A read of one walk passes over the row groups whose filter does not know it, also
# where they hold so many walks that no dictionary does; filters are as small as they can be.
BLOOM = {
    "parquet.bloom.filter.enabled#walk_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


class ResultCache:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.checkpoint = f"{root}/checkpoint"
        self.changelog = f"{root}/changelog"
        self.base = f"{root}/base"
        self.manifest = f"{root}/manifest"
        self.done = LastDone(spark, f"{root}/committed")

    def upsert(self, batch: DataFrame, batch_id: int, files_per_date: int | None = None) -> None:
        """Write the rows of one micro-batch under its number.

        A batch that is run again overwrites its own folder, so nothing doubles.
        An empty batch writes no data file: tasks without rows open none in a
        partitioned write. The batch is thus evaluated once and needs no caching.
        """
        rows = batch.withColumn(DATE.name, F.to_date("window_start"))
        if files_per_date:
            rows = spread_over_files(rows, [F.col(DATE.name)], CACHE_KEY, files_per_date)
        folder = f"{self.changelog}/batch_id={batch_id}"
        rows.write.mode("overwrite").options(**BLOOM).partitionBy(DATE.name).parquet(folder)
        self.done.mark(max(batch_id, self.done.last() or 0))

    def start(
        self,
        stats: DataFrame,
        trigger: Trigger = Trigger(every=10),
        name: str | None = None,
        view: str | None = None,
        files_per_date: int | None = None,
        partitions: int | None = None,
    ) -> StreamingQuery:
        """Keep the cache up to date with a stream of window statistics.

        Only windows that changed are written, by all the stream's partitions, so
        that a date with all the changes has as many writers as any. Where that
        leaves too many small files, ``files_per_date`` first brings a date's
        changes together on so many tasks.

        ``view`` names a temporary view of the newest rows, brought up to date
        after each batch: a live table whose state ends with the watermark and
        whose rows stay off the driver.
        """
        require_checkpoint(self.spark, self.checkpoint, self.changelog)

        def on_batch(batch: DataFrame, batch_id: int) -> None:
            self.upsert(batch, batch_id, files_per_date)
            self.show(view)

        self.show(view)
        writer = cache_rows(stats).writeStream.foreachBatch(on_batch).outputMode("update")
        return start_stream(self.spark, writer, self.checkpoint, trigger, name, partitions)

    def committed(self) -> int | None:
        """The last batch whose rows are all there."""
        return self.done.last()

    def bases(self) -> dict[dt.date, int]:
        """Per date the last batch that its newest base covers; as many entries as dates.

        The newest manifest tells it whole, so reading it takes no Spark job.
        """
        numbers = self._manifests()
        if not numbers:
            return {}
        entries = json.loads(read_text(self.spark, f"{self.manifest}/{numbers[-1]}"))
        return {dt.date.fromisoformat(date): upto for date, upto in entries.items()}

    def _manifests(self) -> list[int]:
        names = (path.rpartition("/")[2] for path in listed(self.spark, f"{self.manifest}/*"))
        return sorted(int(name) for name in names if name.isdigit())

    def compacted_through(self) -> int | None:
        """The last batch that any base covers."""
        return max(self.bases().values(), default=None)

    def versions(self, through: int | None = None) -> DataFrame:
        """All stored versions of rows: of each date the newest base and the batches after it.

        Batches that are not committed, such as one a lost driver left half
        written, are not read.
        """
        last = self.committed()
        if last is None:
            return self.spark.createDataFrame([], LOGGED)
        through = last if through is None else min(through, last)
        bases = self.bases()
        rows = self.spark.read.schema(LOGGED).parquet(self.changelog)
        rows = rows.filter(F.col("batch_id") <= through)
        if not bases:
            return rows
        date = F.col(DATE.name)
        entries = [F.lit(x) for entry in bases.items() for x in entry]
        upto = F.element_at(F.create_map(*entries), date)
        # Both are conditions on folder names, so folders that don't count are not opened.
        rows = rows.filter(upto.isNull() | (F.col("batch_id") > upto))
        base = self.spark.read.schema(BASE).parquet(self.base).filter(F.col("upto") == upto)
        return base.withColumnRenamed("upto", "batch_id").unionByName(rows)

    def stored(self, through: int | None = None) -> DataFrame:
        return latest_wins(self.versions(through), VIEW_KEY).select(*STORED.fieldNames())

    def rows(self) -> DataFrame:
        """The cache: one row per walk, device, sensor and window, its newest version."""
        return self.stored().select(*CACHE.fieldNames())

    def show(self, view: str | None) -> None:
        """Turn a temporary view to the newest rows, as after a batch or a compaction."""
        if view:
            self.rows().createOrReplaceTempView(view)

    def read(self, wanted: CacheFilter, day: str | dt.date | None = None) -> DataFrame:
        """Rows of one walk and sensor in a year, or on one day of it, in time order.

        Dates are also compared with the folders, so other days are not opened.
        """
        date = F.col(DATE.name)
        first, after = year_bounds(wanted.year)
        rows = self.stored().filter((date >= F.lit(first)) & (date < F.lit(after)))
        rows = on_walk(rows, wanted.walk_id)
        rows = on_sensor(rows, wanted.sensor_type)
        rows = in_year(rows, wanted.year)
        if day is not None:
            rows = on_day(rows.filter(date == F.lit(parse_day(day))), day)
        shown = [name for name in CACHE.fieldNames() if name not in ("device_id", "updated_at")]
        return rows.select(*shown).orderBy("window_start")

    def compact(self, through: int | None = None) -> None:
        """Write the newest rows of the batches up to ``through`` as bases, date by date.

        ``through`` is the last committed batch by default and none after it can
        be asked for. Only dates with rows changed since their base are written.
        Files are cut by ranges of date, sensor, walk and time, so that a date
        with much of the data gets many files and a read of one walk opens few.
        Readers take to the new bases when their manifest is there; until
        then, and if this fails, the old ones stay in use.
        """
        last = self.committed()
        if through is None:
            through = last
        if through is None:
            return
        if last is None or through > last:
            raise ValueError(f"batch {through} is not committed; the last that is: {last}")
        bases = self.bases()
        changed = [date for date, batch in self._changes(through) if batch > bases.get(date, -1)]
        if not changed:
            return
        rows = self.stored(through).filter(F.col(DATE.name).isin(changed))
        (
            rows.repartitionByRange(*FILE_ORDER)
            .sortWithinPartitions(*FILE_ORDER)
            .write.mode("overwrite")
            .options(**BLOOM)
            .partitionBy(DATE.name)
            .parquet(f"{self.base}/upto={through}")
        )
        entries = {date.isoformat(): upto for date, upto in bases.items()}
        entries |= {date.isoformat(): through for date in changed}
        write_text(self.spark, f"{self.manifest}/{through}", json.dumps(entries))
        # The one before stays for readers that have just found its name.
        for number in self._manifests()[:-2]:
            drop_folder(self.spark, f"{self.manifest}/{number}")

    def _changes(self, through: int) -> list[tuple[dt.date, int]]:
        """Per date the newest batch up to ``through`` that changed it, by folder names."""
        newest: dict[dt.date, int] = {}
        for path in listed(self.spark, f"{self.changelog}/batch_id=*/{DATE.name}=*"):
            batch, date = _folder(path)
            if batch <= through:
                newest[date] = max(batch, newest.get(date, -1))
        return sorted(newest.items())

    def drop_compacted(self) -> list[int]:
        """Delete batch folders that bases cover, and bases that newer ones replace.

        Returns the numbers of the batches that are wholly gone. Keeps the listing
        of the changelog short in a long run. Readers that took the view before
        the compaction must have finished.
        """
        bases = self.bases()
        if not bases:
            return []
        left: dict[int, int] = {}
        for path in listed(self.spark, f"{self.changelog}/batch_id=*/{DATE.name}=*"):
            batch, date = _folder(path)
            if batch <= bases.get(date, -1):
                drop_folder(self.spark, path)
            else:
                left[batch] = left.get(batch, 0) + 1
        for path in listed(self.spark, f"{self.base}/upto=*/{DATE.name}=*"):
            upto, date = _folder(path)
            if upto < bases.get(date, -1):
                drop_folder(self.spark, path)
        covered = max(bases.values())
        gone = []
        for path in listed(self.spark, f"{self.changelog}/batch_id=*"):
            batch = int(path.rpartition("=")[2])
            if batch <= covered and batch not in left:
                drop_folder(self.spark, path)
                gone.append(batch)
        return sorted(gone)


def _folder(path: str) -> tuple[int, dt.date]:
    """Number and date of a folder ``.../name=N/window_date=D``."""
    above, _, date = path.rpartition(f"/{DATE.name}=")
    return int(above.rpartition("=")[2]), dt.date.fromisoformat(date)


def connector_upsert(connector: str, **options: str):
    """A per-batch writer for an external keyed store, through its own connector.

    Empty batches are left out. A batch is kept for the test and the write, so
    that the stream's work for it is done once; lost parts are worked out again.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                batch.write.format(connector).mode("append").options(**options).save()
        finally:
            batch.unpersist()

    return on_batch
