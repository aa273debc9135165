"""What the operators share: reading tables, cutting lineage, numbering and splitting groups."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

import barograph
from barograph.session import task_count
from barograph.workspace import fresh_folder

#: Bytes that separate words: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for functions run there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(barograph.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="barograph-code-")) / "barograph.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(rows: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write as Parquet to a new shared folder; the table read from there, and the folder.

    The folder goes by ``drop_folder``, or else when the driver ends.
    """
    spark = rows.sparkSession
    folder = fresh_folder(spark, label)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder), folder


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Write once as Parquet in the shared folder and read from there.

    Later steps read the columns they need, and none repeats the work if an
    executor is lost. The folder goes when the driver ends.
    """
    return written(rows, label)[0]


def numbered(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str, salts: int | None = None
) -> DataFrame:
    """Add ``name``: a number from 0 without gaps within each group.

    ``rows`` is a table as ``stored`` gives it. A group may hold most of the
    rows, and most of them may be equal: rows are dealt to salts by their own
    place in the files and numbered there, and the salts' sizes, few rows, give
    the offsets. The order of ``order`` holds within a salt only. Equal rows get
    different numbers.
    """
    salts = salts or 4 * task_count(rows.sparkSession)
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
    place = F.xxhash64(part, "_metadata.row_index")
    salted = rows.select("*", F.pmod(place, F.lit(salts)).alias("_salt"))
    keys = [*group, "_salt"]
    sizes = salted.groupBy(*keys).agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    ranked = salted.withColumn("_within", within)
    return ranked.join(starts, keys).select(
        *rows.columns, (F.col("_start") + F.col("_within")).cast("long").alias(name)
    )


def split_groups(rows: DataFrame, member: str, size: str, bound: int) -> DataFrame:
    """Deal each group's pairs over parts of about twice ``bound`` rows at most.

    ``size`` is the number of rows of the group. A group within the bound is one
    part. A larger one is cut by hash into blocks of about ``bound`` rows, and
    each two blocks meet in one part, so every pair of members meets somewhere
    and no task takes an unbounded group. Adds ``part_a`` and ``part_b``.
    """
    blocks = F.ceil(F.col(size) / F.lit(bound)).cast("int")
    own = F.pmod(F.xxhash64(F.col(member), F.lit(7)), F.col("_blocks")).cast("int")
    met = rows.withColumn("_blocks", blocks).withColumn("_own", own)
    met = met.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return met.select(
        *rows.columns,
        F.least("_own", "_other").alias("part_a"),
        F.greatest("_own", "_other").alias("part_b"),
    )


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))
