"""Folders that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: list[str] = []


def available(spark: SparkSession) -> bool:
    """Whether there is such a folder: a session on one machine always has one."""
    master = spark.sparkContext.master
    return bool(spark.conf.get("spark.checkpoint.dir", None)) or master.startswith("local") and not master.startswith("local-cluster")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder that spark.checkpoint.dir names. Without one a local session gets a temporary folder; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not available(spark):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="ledgerloom-files-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        found = _own[0]
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again: computed once, planned once, and still there after an executor is lost."""
    path = fresh_path(rows.sparkSession, name)
    rows.write.parquet(path)
    out = rows.sparkSession.read.schema(rows.schema).parquet(path)
    out.stored_at = path
    return out


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """A query that runs inside leaves no shuffle files: they go as it ends, not when the driver's JVM happens to collect what it was."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


# Where a row of ``stored_in_order`` lies: the range of its file, and where the split of that file begins.
PLACE = ("_range", "_block")


def stored_in_order(rows: DataFrame, name: str, order: list[str]) -> DataFrame:
    """As ``stored``, sorted by order, with the columns of ``PLACE``. Rows of one place are read in order by one task, and places sort as the rows do, so whatever is written from it in order needs no shuffle.

    Rows are stored as they come before they are sorted, so that what they come from is computed once and, within ``shuffles_dropped``, its shuffles are gone when the sort's is written.
    """
    spark, first, path = rows.sparkSession, fresh_path(rows.sparkSession, f"{name}-unsorted"), fresh_path(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(first)
    rows = spark.read.schema(rows.schema).parquet(first).orderBy(*order).withColumn(PLACE[0], F.spark_partition_id())
    rows.write.option("compression", "zstd").parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(first)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    out = spark.read.schema(rows.schema).parquet(path).withColumn(PLACE[1], F.col("_metadata.file_block_start"))
    out.stored_at = path
    return out
