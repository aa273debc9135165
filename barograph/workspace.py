"""Shared folder for checkpoints and tables that a run writes for itself."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else set on the context.

    Executors on other machines must reach it, so only a master within one
    process may do without: it gets a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="barograph-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared root; never reused by another run.

    What is written there belongs to this run: it goes when the driver ends, or
    sooner by ``drop_folder``.
    """
    own = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    files, path = file_system(spark, own)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{own}/run"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of ``fresh_folder``, or any other, with all in it."""
    files, path = file_system(spark, folder.removesuffix("/run"))
    files.delete(path, True)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path and the path as it takes it."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(context._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop = file_system(spark, path)
    return files.exists(hadoop)


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern of the file system; no folder below is listed."""
    files, hadoop = file_system(spark, pattern)
    return [status.getPath().toString() for status in files.globStatus(hadoop) or ()]


def age_seconds(spark: SparkSession, path: str) -> float:
    """How long ago the path was changed, by the clock of the driver's machine."""
    files, hadoop = file_system(spark, path)
    now = spark.sparkContext._jvm.System.currentTimeMillis()
    return (now - files.getFileStatus(hadoop).getModificationTime()) / 1000


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, shown under its name only when all of it is there."""
    files, hadoop = file_system(spark, path)
    # Names that begin with an underscore are no data to Spark's readers.
    staged = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        hadoop.getParent(), f"_{hadoop.getName()}-{uuid.uuid4().hex}"
    )
    out = files.create(staged, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(hadoop, False)
    files.rename(staged, hadoop)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file of ``write_text``, read by the driver."""
    files, hadoop = file_system(spark, path)
    stream = files.open(hadoop)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


class LastDone:
    """The number of the last finished version of some output.

    ``mark`` is called once all files of a version are there; until then readers
    see the version before. The number is the name of an empty file, which the
    file system creates at once or not at all. Older marks are removed.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def _marks(self) -> list[int]:
        return sorted(int(path.rpartition("/")[2]) for path in listed(self.spark, f"{self.folder}/*"))

    def mark(self, number: int) -> None:
        files, path = file_system(self.spark, f"{self.folder}/{number}")
        files.create(path, True).close()
        for older in self._marks():
            if older < number:
                drop_folder(self.spark, f"{self.folder}/{older}")

    def last(self) -> int | None:
        marks = self._marks()
        return marks[-1] if marks else None
