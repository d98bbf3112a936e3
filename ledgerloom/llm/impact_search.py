"""Exact top-k search by inner product over an impact-ordered index.

Components become integers floor(1024 x). A shard of vectors is indexed as postings (vector, dimension, sign), ordered by impact: a power of two. A component has a posting for its size, quantised, one for what that leaves, and so
on, two to three of them mostly, so that what is left shrinks by half with each power. A segment holds all postings of one impact. A query
processes segments score at a time, from the highest impact down, adding the query's component of each posting's dimension to the posting's vector. After a segment, what a
vector may still gain or lose is bounded by Cauchy and Schwarz from the lengths of the query and of the vector's unprocessed rest, both
known exactly. Processing stops when the bound proves that only so few vectors can be members of the query's top k that to rescore them takes less than the next segment; these possible members
are rescored exactly. If no bound proves it, all segments are used, after which the scores are exact.

Shards have a fixed size and travel once; queries come to each shard in batches, behind the shard's vectors in the sort order of its partition, so a task holds one index and one
batch. The k best of every shard are merged by a window that keeps k rows a query and shard. Nothing is collected but two counts.

Defined cases: null vectors, or vectors that hold a null or a non-finite component, and rows with a null id take no part; vectors of different
lengths are padded with zeros; a query's own rows (same id) are no candidates, other rows that repeat an id are ranked as they are; of several rows
with a query's id the one with the smallest vector, component by component, asks; ties go to the smaller id; fewer than k candidates give all; components beyond 2^20 after
scaling are scored with exact integers of any size and clipped to 64 bits; extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import common  # noqa: F401  (sends functions of this library by value)

SCALE = 1024
EXACT = 1 << 20
SCHEMA = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, v): ids and integer components of vectors that take part. v is double; sizes beyond 2^53 are whole anyway."""
    x = F.transform(column, lambda c: c.cast("double"))
    fine = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")))
    rows = vectors.where(F.col(id_column).isNotNull() & F.col(column).isNotNull() & F.coalesce(fine, F.lit(False)))
    # floor of a double stays a double through rint of the difference: values beyond the range of long must not overflow
    whole = lambda c: F.when(F.abs(c) < 2.0**52, F.floor(c).cast("double")).otherwise(c)
    return rows.select(F.col(id_column).cast("long").alias("vec_id"), F.transform(x, lambda c: whole(c * SCALE)).alias("v"))


class Index:
    """Postings of a shard in segments of falling impact.

    A component is a sum of signed powers of two: at each power from the largest down, what is left of it gives a posting if it exceeds two thirds of the power, and is then at most a third of it away. So after a segment nothing
    that is left of any component exceeds two thirds of the segment's power, and after the last nothing is left.
    """

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.matrix = ids[order], matrix[order]
        left, self.segments, self.rest = self.matrix.copy(), [], []
        for power in range(int(np.abs(left).max(initial=0)).bit_length(), -1, -1):
            rows, dims = np.nonzero(3 * np.abs(left) > 2 << power)
            if len(rows):
                impact = np.sign(left[rows, dims]) * (1 << power)
                left[rows, dims] -= impact
                self.segments.append((rows.astype(np.int32), dims.astype(np.int32), impact.astype(np.float32)))
                # Length of what is left of each vector.
                self.rest.append(np.sqrt((left**2).sum(1)))
        self.used = self.rescored = 0

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best of the shard. Segments are processed until the bound leaves so few possible members that to rescore them takes less than the next segment. ``used`` and ``rescored`` count postings and vectors."""
        n, partial, length = len(self.ids), np.zeros(len(self.ids)), float(np.sqrt((query**2).sum()))
        members = np.flatnonzero(self.ids != query_id)
        for (rows, dims, impact), rest in zip(self.segments, self.rest, strict=True):
            if len(members) <= k or len(members) * len(query) <= len(rows):
                break
            partial += np.bincount(rows, impact * query[dims], n)
            self.used += len(rows)
            slack = length * rest[members] * (1 + 1e-9) + 1e-3
            low = partial[members] - slack
            least = np.partition(low, len(low) - k)[len(low) - k]
            members = members[partial[members] + slack >= least]
        self.rescored += len(members)
        # products below 2^20 squared, over fewer than 2^13 dimensions, are exact in a double
        scores = self.matrix[members] @ query
        best = np.lexsort((self.ids[members], -scores))[:k]
        return self.ids[members][best], scores[best].astype(np.int64)


def exact_search(ids: np.ndarray, rows: list[list[float]], query_ids: np.ndarray, queries: list[list[float]], k: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """For components too large for doubles: integers of any size."""
    whole = [[int(c) for c in r] for r in rows]
    for q, v in zip(query_ids, queries, strict=True):
        w = [int(c) for c in v]
        scored = sorted(((-sum(a * b for a, b in zip(w, r, strict=False)), int(i)) for i, r in zip(ids, whole, strict=True) if i != q))[:k]
        clip = lambda s: max(-(2**63), min(2**63 - 1, s))
        yield int(q), [i for _, i in scored], [clip(-s) for s, _ in scored]


def vectors_of(column: pa.Array) -> list[np.ndarray]:
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    return [values[i:j] for i, j in itertools.pairwise(offsets)]


def dense(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v[:width]
    return out


class Shard:
    """The vectors of one shard as they arrive, and the index made of them when the first query comes."""

    def __init__(self) -> None:
        self.ids: list[np.ndarray] = []
        self.vectors: list[np.ndarray] = []
        self.index: Index | None = None

    def add(self, ids: np.ndarray, vectors: list[np.ndarray]) -> None:
        self.ids.append(ids)
        self.vectors += vectors

    def answer(self, query_ids: np.ndarray, queries: list[np.ndarray], k: int) -> Iterator[tuple[int, Sequence[int], Sequence[int]]]:
        if not self.vectors:
            return
        if len(self.ids) > 1 or self.index is None:
            self.ids = [np.concatenate(self.ids)]
            self.width = max(map(len, self.vectors))
            self.large = any(len(v) and np.abs(v).max() >= EXACT for v in self.vectors)
            self.index = None if self.large else Index(self.ids[0], dense(self.vectors, self.width))
        large = self.large or self.width >= 1 << 13 or any(len(v) and np.abs(v).max() >= EXACT for v in queries)
        if large:
            yield from exact_search(self.ids[0], self.vectors, query_ids, queries, k)
        else:
            # What a query has beyond the shard's width meets zeros.
            for q, v in zip(query_ids.tolist(), dense(queries, self.width), strict=True):
                yield q, *self.index.search(q, v, k)


def search_shards(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Batches of (shard, asks, vec_id, v) sorted by shard and asks: each shard's vectors, then its queries."""
    number, shard = None, Shard()
    for batch in batches:
        if not batch.num_rows:
            continue
        numbers, asks, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        vectors = vectors_of(batch.column(3))
        edges = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
        for i, j in itertools.pairwise([0, *edges.tolist(), len(ids)]):
            if numbers[i] != number:
                number, shard = numbers[i], Shard()
            if not asks[i]:
                shard.add(ids[i:j], [v.copy() for v in vectors[i:j]])
                continue
            parts = [(np.full(len(x), q, np.int64), np.asarray(x, np.int64), np.asarray(s, np.int64)) for q, x, s in shard.answer(ids[i:j], vectors[i:j], k)]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[c] for p in parts])) for c in range(3)], ["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query: F.Column, k: int = 10, shard_rows: int = 16_384) -> DataFrame:
    """query_id, rank, vec_id, score: for each query id the k highest inner products, ties to the smaller vec_id. is_query picks queries among rows of quantised vectors by vec_id."""
    rows = quantised(vectors)
    shards = max(1, math.ceil(rows.count() / shard_rows))
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    # The row's place in its file is hashed too, so that rows that repeat one vector and id are spread over the shards.
    index = rows.select(F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("asks"), "vec_id", "v")
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("asks"), "vec_id", "v")
    dealt = index.unionByName(asked).repartition("shard").sortWithinPartitions("shard", "asks")
    found = dealt.mapInArrow(lambda batches: search_shards(batches, k), SCHEMA)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
