"""Intermediate results kept in shared storage, so that lost executors cost no recomputation."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints. A local one stands in for it in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name in the shared scratch folder."""
    return f"{scratch_dir(spark).rstrip('/')}/logsight/{label}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def create_file(spark: SparkSession, path: str, text: str, stale_hours: float) -> bool:
    """Create a file that is not there yet; false if it is. One that is older than stale_hours is replaced.

    The file system decides who is first, so of several callers one succeeds.
    """
    jvm, name = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(path)
    system = name.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(name):
        age = jvm.java.lang.System.currentTimeMillis() - system.getFileStatus(name).getModificationTime()
        if age < stale_hours * 3_600_000:
            return False
        # of several that find it stale, the one that moves it away goes on
        if not system.rename(name, jvm.org.apache.hadoop.fs.Path(f"{path}.stale-{uuid.uuid4().hex}")):
            return False
    try:
        out = system.create(name, False)
    except Py4JJavaError:  # another was first
        return False
    out.write(bytearray(text.encode()))
    out.close()
    return True


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none when it does not exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in system.listStatus(folder)] if system.exists(folder) else []


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    paths = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target)]
    system = paths[0].getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(paths[1].getParent())
    if not system.rename(*paths):
        raise OSError(f"{source} could not be moved to {target}")


def materialise(df: DataFrame, label: str, partition_by: list[str] | None = None, path: str | None = None) -> DataFrame:
    """Write a result once and read it back: later uses scan it with known size and statistics."""
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    writer = df.write.option("compression", "lz4")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate results of one piece of work, deleted with it: ``with Scratch(spark) as keep: keep(df, "x")``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        self.paths.append(scratch_path(self.spark, label))
        return materialise(df, label, path=self.paths[-1])

    def __exit__(self, *_: object) -> None:
        for path in self.paths:
            delete_folder(self.spark, path)
