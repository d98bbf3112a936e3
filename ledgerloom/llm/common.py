"""What the operators share: checked storage, Arrow maps and word splitting.

A word is a maximal run of characters other than U+0020 and U+0009 to U+000D, which is exactly what
``bytes.split()`` gives on UTF-8.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import shutil
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this library travel to executors by value, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules["ledgerloom"])

_SEPARATORS = "\\x20\\x09-\\x0D"


# Rows of an Arrow batch that are worked on at a time.
PART_ROWS = 1000

# Rows of narrow tables for which another file is worth a task.
ROWS_PER_FILE = 200_000

_own: list[str] = []
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Without one, a local session gets a temporary folder; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="ledgerloom-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        found = _own[0]
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage and outlives executors. rows: how many there are at most, where it is known; few need few files."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    (df if rows is None else df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for t in tables:
        _delete(t.sparkSession, t.stored_at)


def release(spark: SparkSession, *keep: DataFrame) -> None:
    """Delete all that was written to the shared folder by this driver, but the tables to keep. Results that are still to be read must be among them."""
    kept = {t.stored_at for t in keep}
    for path in [p for p in _written if p not in kept]:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    if path in _written:
        _written.remove(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, nulls as None."""
    return column.cast(pa.binary()).to_pylist()


def give_back() -> None:
    """Return memory that Python and Arrow hold unused, as workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def arrow_map(df: DataFrame, f: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch] | pa.RecordBatch | None], schema: str) -> DataFrame:
    """mapInArrow with a function of one batch, which is handed on in parts, so that what Python makes of it stays small beside it."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PART_ROWS):
                out = f(batch.slice(at, PART_ROWS))
                if out is not None:
                    yield out
            del batch
        give_back()

    return df.mapInArrow(each, schema)


def bounded_side(rows: DataFrame, most: int = 400_000) -> DataFrame:
    """Broadcast if it has few rows, counted; else left to the join's shuffle. rows must be cheap to count and of at most a hundred bytes each, so at most 40 MB are sent."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def join_counted(rows: DataFrame, counts: DataFrame, key: str, n: str, least: int = 256, most: int = 100_000) -> DataFrame:
    """rows joined with counts, which has each key once and how many rows hold it, without a key that is hot in one task.

    Keys of more rows than ``least``, and than one in ``most`` of all, are joined by a broadcast: of these there are at most ``most``, so the
    bound holds at any size. The rest is shuffled. counts must be stored, with rows of at most a hundred bytes.
    """
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    limit = max(least, total // most)
    hot = F.broadcast(counts.where(F.col(n) > limit))
    return rows.join(hot.select(key), key, "left_anti").join(counts.where(F.col(n) <= limit), key).unionByName(rows.join(hot, key))


def word_count(text: str | F.Column) -> F.Column:
    """Number of words, native; 0 for null. Each word begins after a separator; nothing but the count is made."""
    return F.coalesce(F.regexp_count(F.concat(F.lit(" "), text), F.lit(f"[{_SEPARATORS}][^{_SEPARATORS}]")), F.lit(0)).cast("long")


def has_words(text: str | F.Column) -> F.Column:
    """Whether there is a word; the search ends at the first."""
    return F.coalesce(F.regexp_like(text, F.lit(f"[^{_SEPARATORS}]")), F.lit(False))
