"""Run folders, and how output folders are filled."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from barograph.session import scoped_conf
from barograph.streaming.starting import spread_over_files
from barograph.workspace import LastDone, drop_folder, fresh_folder, path_exists, shared_root


def test_folders_lie_under_the_configured_root(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    one, two = fresh_folder(spark, "x"), fresh_folder(spark, "x")
    assert one != two and one.startswith(f"{root}/x-")


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}/own"


def session(master):
    conf = SimpleNamespace(get=lambda key, default: default)
    return SimpleNamespace(conf=conf, sparkContext=Context(master))


def test_only_a_local_master_may_do_without():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(session("yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(session("local-cluster[2,1,1024]"))
    local = session("local[2]")
    assert shared_root(local) == shared_root(local) == local.sparkContext.folder


def test_own_folders_can_go(spark, tmp_path):
    folder = fresh_folder(spark, "y")
    spark.range(3).write.parquet(folder)
    assert path_exists(spark, folder)
    drop_folder(spark, folder)
    assert not path_exists(spark, folder.removesuffix("/run"))


def test_the_last_mark_counts(spark, tmp_path):
    done = LastDone(spark, str(tmp_path / "marks"))
    assert done.last() is None
    for number in (0, 1, 10, 9):
        done.mark(number)
    assert done.last() == 10


def test_path_exists(spark, tmp_path):
    assert not path_exists(spark, str(tmp_path / "none"))
    (tmp_path / "_hidden").mkdir()
    assert path_exists(spark, str(tmp_path / "_hidden"))


def test_a_folder_with_most_rows_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 3000, numPartitions=6).select(
        "id", F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(7).alias("day")
    )
    path = str(tmp_path / "out")
    # As in a stream's batches, which do not merge small partitions at run time.
    with scoped_conf(spark, spark__sql__adaptive__enabled="false"):
        spread_over_files(rows, [F.col("day")], ["id"], 4).write.partitionBy("day").parquet(path)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "out").glob("day=*")}
    assert 1 < files["day=7"] <= 4 and max(files.values()) <= 4
    assert spark.read.parquet(path).count() == 3000
