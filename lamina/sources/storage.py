"""Directory operations through Spark's own file system layer (local, HDFS, object store).

The driver asks about directories, whose number follows the layout, and gets all answers of a
listing in one call. Files are looked up by Spark's listing and tasks: see `file_table`.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_COLUMNS = "directory string, name string, bytes long, modified timestamp"


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _open(spark, path)
    return system.exists(target)


def qualified(spark: SparkSession, path: str) -> str:
    """The path of a file or directory as its file system names it, decoded, with its scheme."""
    system, target = _open(spark, path)
    return system.makeQualified(target).toString().rstrip("/")


def without_scheme(spark: SparkSession, path: str) -> str:
    system, target = _open(spark, path)
    return system.makeQualified(target).toUri().getPath().rstrip("/")


def size_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under a path, by listing only."""
    system, target = _open(spark, path)
    return system.getContentSummary(target).getLength()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted. For directories, whose number is bounded by the layout."""
    system, target = _open(spark, pattern)
    found = system.globStatus(target)
    if not found:
        return []
    # The paths as one text: an element of a Java array costs a call.
    paths = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found)
    return sorted(spark._jvm.scala.Predef.genericWrapArray(paths).mkString("\n").split("\n"))


def file_table(spark: SparkSession, path: str) -> DataFrame:
    """(directory below the path, name, bytes, modified) of the data files there, as Spark lists them.

    Many directories are listed by a Spark job, and the rows are made by tasks, so that the driver makes no
    call per file; run the result within `listing`. Names that start with a dot or an underscore are no
    data, but for `name=value` directories, and neither is a file of no bytes. No such path gives no rows; a
    path that is a file gives it in directory ''.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], FILE_COLUMNS)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    parts = F.split(F.substring("path", len(qualified(spark, path)) + 2, 1 << 30), "/")
    is_file = parts[0] == ""
    return found.select(
        F.when(is_file, "").otherwise(F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")).alias("directory"),
        F.substring_index("path", "/", -1).alias("name"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


@contextmanager
def listing(spark: SparkSession) -> Iterator[None]:
    """Queries on `file_table` run in here: they read no bytes, so as many tasks as there are cores are enough."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(1 << 60))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or directory to a name that is free, whose parents are made."""
    system, old = _open(spark, source)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    system.mkdirs(new.getParent())
    if system.exists(new) or not system.rename(old, new):
        raise OSError(f"cannot rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    system, target = _open(spark, path)
    system.delete(target, True)
