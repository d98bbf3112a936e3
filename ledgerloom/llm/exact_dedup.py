"""Exact deduplication by progressive refinement: length, then a hash of the prefix, then a hash of everything. Native expressions only.

Two texts are equal if they are identical once every character of ``[\\x20\\x09-\\x0D]`` is deleted; null counts as empty. Of equal texts the row with
the most code points in its original text stays, then the one with the smallest doc_id (a null id comes last), then, among rows that repeat both, the first read.

1. A first scan leaves the length and the hash of the first ``prefix`` characters of each text in a narrow table. Rows whose length is theirs alone are settled.
2. The rest is grouped by length and prefix hash. Rows alone in their group are settled.
3. A second scan takes the SHA-256 of whole texts, but only where the groups of step 2 have several rows, and groups by it.

The outcome of a step reaches the next scan as a set of buckets, ``BUCKETS`` of them at most, so what is broadcast does not grow with the data. A row that shares a
bucket without sharing the group is hashed once more than it would need; it cannot join a wrong group, as only whole hashes group. Texts never
leave the scan unless they are asked for. Groups combine before the shuffle, and the join that hands their keeper back treats large groups apart, so a text that fills a third of the table is no hot key.

Null and empty texts are equal to each other and to texts of white space only; very long texts are hashed whole; rows that repeat an id and a text are
copies like any others, one of them stays; null ids are kept and never preferred; extra columns are ignored (or handed through in a struct, whatever their names); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import join_counted, stored

# The most rows that a broadcast set of buckets can have, 8 bytes each.
BUCKETS = 1 << 18


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), F.lit("[\\x20\\x09-\\x0D]+"), F.lit(""))


def _bucket(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("bucket")


def _measured(docs: DataFrame, prefix: int, *columns: Column | str) -> DataFrame:
    rows = docs.select(*columns, normalised().alias("norm"))
    return rows.select("*", F.octet_length("norm").alias("size"), F.xxhash64(F.substring("norm", 1, prefix)).alias("prefix"))


def _shared(rows: DataFrame, *keys: str) -> DataFrame:
    """The buckets of keys that several rows hold."""
    return F.broadcast(rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(_bucket(*keys)).distinct())


def undecided(docs: DataFrame, prefix: int = 64) -> DataFrame:
    """(bucket) of the lengths and prefix hashes that several rows share: at most BUCKETS rows."""
    narrow = stored(_measured(docs, prefix).select("size", "prefix"), "exact-sizes")
    of_shared_length = narrow.withColumn("bucket", _bucket("size")).join(_shared(narrow, "size"), "bucket", "left_semi")
    return stored(_shared(of_shared_length, "size", "prefix"), "exact-buckets", BUCKETS)


def exact_groups(docs: DataFrame, prefix: int = 64, digest_all: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """One row for each of docs (doc_id, text): doc_id, keep_id, group_size, kept, digest (SHA-256; null where refinement settled the row earlier, unless digest_all), and, with carry, a struct ``document`` of these columns."""
    # The row's number settles which of wholly equal rows stays; it is stored before it is used.
    columns = ["doc_id", F.length(F.coalesce("text", F.lit(""))).alias("points"), F.monotonically_increasing_id().alias("row"), *([F.struct(*carry).alias("document")] if carry else [])]
    rows = _measured(docs, prefix, *columns).withColumn("bucket", _bucket("size", "prefix"))
    rows = rows.join(F.broadcast(undecided(docs, prefix).select("bucket", F.lit(True).alias("open"))), "bucket", "left").withColumn("open", F.coalesce("open", F.lit(False)))
    digest = F.unhex(F.sha2("norm", 256))
    rows = stored(rows.select("doc_id", "points", "row", "open", (digest if digest_all else F.when(F.col("open"), digest)).alias("digest"), *(["document"] if carry else [])), "exact-rows")
    settled, rest = rows.where("not open"), rows.where("open")

    best = F.min(F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    groups = stored(rest.groupBy("digest").agg(F.count("*").alias("group_size"), best.alias("best")).select("digest", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row")), "exact-groups")
    out = lambda t, keep, size, kept: t.select("doc_id", keep.alias("keep_id"), size.alias("group_size"), kept.alias("kept"), "digest", *(["document"] if carry else []))
    grouped = join_counted(rest, groups, "digest", "group_size")
    return out(settled, F.col("doc_id"), F.lit(1).cast("long"), F.lit(True)).unionByName(out(grouped, F.col("keep_id"), F.col("group_size"), F.col("row") == F.col("keep_row")))


def deduplicate(docs: DataFrame, prefix: int = 64) -> DataFrame:
    """docs, all columns, without the rows that an equal text stands for."""
    return exact_groups(docs, prefix, carry=docs.columns).where("kept").select("document.*")
