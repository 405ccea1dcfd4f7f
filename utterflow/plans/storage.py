"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Up to here a table whose size depends on the data is broadcast. Beyond, it is
# joined by shuffle.
BROADCAST_BYTES = 128 * 1024 * 1024


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="utterflow-")


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, or what ``setCheckpointDir`` has set.

    With neither, a temporary folder in local mode, where one machine sees it all. On a cluster
    that is an error: executors would write to their own disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if set_by_call := context.getCheckpointDir():
        return set_by_call
    if re.match(r"local(\[|$)", context.master):
        return _local_folder()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(table: DataFrame) -> DataFrame:
    """The table written to the shared folder and read back.

    It outlives lost executors, is computed once however often it is used, and
    every use sees the same rows. It goes when the driver's JVM ends.
    """
    spark = table.sparkSession
    path = new_folder(spark, "table")
    table.write.parquet(path)
    delete_at_end(spark, path)
    return spark.read.schema(table.schema).parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme that Spark takes it to have, for readers that ask no Spark."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return folder.getFileSystem(conf).makeQualified(folder).toString()


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder at a path, on whatever file system it is on."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = folder.getFileSystem(conf)
    return files.exists(folder) and files.getFileStatus(folder).isDirectory()


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Deletes a folder when the driver's JVM ends in an orderly way."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder.getFileSystem(conf).deleteOnExit(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder on whatever file system it is on; a missing one is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder.getFileSystem(conf).delete(folder, True)


def fits_broadcast(table: DataFrame, limit: int, *text_columns: str) -> bool:
    """Whether a table of strings is at most ``limit`` bytes, by a full count of it."""
    width = F.lit(64)
    for name in text_columns:
        width = width + F.coalesce(F.octet_length(name), F.lit(0))
    return (table.agg(F.sum(width).alias("size")).first()["size"] or 0) <= limit
