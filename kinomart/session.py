"""Session settings the jobs are written for."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


PARTITION_BYTES = 256 << 20
CODEC = "zstd"  # of stored tables: fewer bytes than Spark's default, snappy
THREADS = 12  # tables written side by side
_work_folders: list[str] = []


def shuffle_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Session settings for a given amount of input: enough shuffle partitions for each to
    stay in memory. Adaptive execution merges those that turn out small."""
    partitions = max(cores, -(-input_bytes // PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
    }


#: Bytes of compressed shuffle data that one task reads.
TASK_BYTES = 16 << 20


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Later shuffles of this session get enough partitions for so much input (shuffled rows take up to
    about four times their files), of which adaptive execution merges no more than TASK_BYTES into a
    task: a task's sorts and hash tables then stay as large as they are, whatever the input."""
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-4 * input_bytes // TASK_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TASK_BYTES))


def local_session(cores: int | str = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("kinomart")
    settings = SETTINGS | {
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": str(os.cpu_count() or 8),
    }
    for key, value in (settings | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """A new folder under the session's shared checkpoint folder.

    Only a local session may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="kinomart-")
    if not _work_folders:
        atexit.register(_at_exit)
    _work_folders.append(f"{root.rstrip('/')}/kinomart-{uuid.uuid4().hex}")
    return _work_folders[-1]


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, place = _path(spark, path)
    return files.exists(place)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a folder."""
    files, place = _path(spark, path)
    return files.getContentSummary(place).getLength()


def remove_folder(spark: SparkSession, path: str) -> None:
    files, place = _path(spark, path)
    files.delete(place, True)


def move_folder(spark: SparkSession, path: str, target: str) -> None:
    files, place = _path(spark, path)
    _, new = _path(spark, target)
    files.mkdirs(new.getParent())
    if not files.rename(place, new):
        raise OSError(f"{path} could not be moved to {target}")


def _replace(spark: SparkSession, fresh: str, path: str) -> None:
    """Put a complete folder in another one's place."""
    files, place = _path(spark, path)
    _, new = _path(spark, fresh)
    _, old = _path(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    files.rename(place, old)
    files.rename(new, place)
    files.delete(old, True)


def remove_work_folders(spark: SparkSession) -> None:
    """Delete the work folders of this process; results that read them are gone afterwards."""
    while _work_folders:
        files, place = _path(spark, _work_folders.pop())
        files.delete(place, True)


def _at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        remove_work_folders(spark)


def materialize(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
    """Write a table in full and read it back.

    A folder that exists is replaced once the new copy is complete, so a failed write leaves it as
    it was, and a table may be written in place of what it reads. The copy cuts the lineage, survives the loss of executors, and has a real size on
    disk, so that Spark broadcasts it only if that size is below its threshold. With ``sort_by`` each
    task's rows are in that order: neighbours are alike, which makes the files and later shuffles smaller.
    """
    rows = df.sortWithinPartitions(*sort_by) if sort_by else df
    if partition_by:
        # One writer per partition at best; large partitions are split, small ones merged.
        rows = df.hint("rebalance", *[F.col(c) for c in partition_by])
    spark = df.sparkSession
    if not folder_exists(spark, path):
        rows.write.partitionBy(*partition_by).parquet(path, compression=CODEC)
    else:  # complete first, then in the old one's place: it may be what is being read
        fresh = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
        rows.write.partitionBy(*partition_by).parquet(fresh, compression=CODEC)
        _replace(spark, fresh, path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
