"""Shared storage for intermediate results."""

from __future__ import annotations

import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

#: The folders that a frame of ``written`` or ``kept_with`` reads.
_folders: WeakKeyDictionary[DataFrame, tuple[str, ...]] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where that is unset, a folder of this machine on a local
    master (as in tests); on a cluster, whose executors don't share one, an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return "/tmp/checkpoints/domscope"


def _hadoop(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def new_folder(spark: SparkSession) -> str:
    """A folder of its own in the shared one, which goes when the application ends, if not before."""
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    fs, path = _hadoop(spark, folder)
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return folder


def held(df: DataFrame, *folders: str) -> DataFrame:
    """df, which reads these folders; discarding it discards them."""
    _folders[df] = folders
    return df


def written(df: DataFrame, *spent: DataFrame) -> DataFrame:
    """df written as Parquet in the shared folder and read back, so that lineage ends there and a lost
    executor costs only tasks. Then the folders of ``spent``, which nothing reads any more, go.

    What no one discards is deleted when the application ends.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}.parquet"
    df.write.parquet(folder)
    fs, path = _hadoop(spark, folder)
    fs.deleteOnExit(path)
    out = spark.read.schema(df.schema).parquet(folder)
    _folders[out] = (folder,)
    discard(*spent)
    return out


def kept_with(df: DataFrame, *sources: DataFrame) -> DataFrame:
    """df, which reads the folders of sources; discarding it discards them."""
    _folders[df] = tuple(f for s in sources for f in _folders.get(s, ()))
    return df


def discard(*frames: DataFrame) -> None:
    """Delete the folders of these frames; nothing that reads them may run afterwards."""
    for df in frames:
        for folder in _folders.pop(df, ()):
            fs, path = _hadoop(df.sparkSession, folder)
            fs.delete(path, True)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
