"""Line deduplication by pairwise alignment.

A block is a run of lines that follow each other (blank lines aside) in two documents and hold ``min_words`` words or more. Blocks
that an alignment finds in a document and an earlier one are deleted from the later.

Documents meet through hashes of their smallest blocks: for each line, the shortest run from it on that holds ``min_words``
words, which mostly is the line itself. Two documents with a block in common share one of these, and nothing else needs to be compared.

1. Documents whose lines are all equal are one class, and all but its first are deleted whole: their alignment is the identity.
   From here on a class is its first document.
2. A block hash is rare if at most ``rare`` documents hold it. Any two documents that share a rare one are a pair.
3. Both documents' line hashes are aligned with patience diff: lines that occur once in both are anchors where they keep their order (longest
   increasing subsequence), gaps between anchors are aligned again, and anchors grow over equal neighbours.
4. A hash held by more documents makes no pairs of its own, so pairs do not grow with the square of a group. Where step 3 leaves
   such a block standing in a document, that document is aligned with the block's first holder.
5. What alignments leave standing, as its order or its repetition has it, is aligned with the first holder's block by itself, which it equals. So no block of an earlier document stays, however many hold it.

Only hashes and positions of lines travel, never texts, until the text of each document meets the ranges to delete.

A document is later than another if its (doc_id, hash of its text) is greater; documents equal in both are one document, and all its
rows get the same result. Null ids and null texts take no part and come back unchanged; empty texts and texts of fewer than ``min_words`` words
hold no block; blank lines are deleted inside a block and else stay; very long texts are compared whole. Extra columns pass through, but those
named ``_ld_...`` are dropped; an empty table gives an empty result. Lines are compared trimmed, by 128-bit hashes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from ledgerloom.llm.common import arrow_map, bounded_side, join_counted, stored

KEY = "struct<id:bigint,t:bigint>"
RANGES = "array<struct<s:int,e:int>>"


def increasing(values: Sequence[int]) -> list[int]:
    """Places of a longest increasing subsequence."""
    tops: list[int] = []
    tails: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        before[i] = tails[k - 1] if k else -1
        tops[k : k + 1] = [v]
        tails[k : k + 1] = [i]
    out, i = [], tails[-1] if tails else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(a: Sequence[bytes], b: Sequence[bytes]) -> list[tuple[int, int]]:
    """Aligned places (in a, in b), increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: i for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1}
        both = [(place[x], j) for j, x in enumerate(b[b0:b1], b0) if in_b[x] == 1 and x in place]
        anchors = [both[i] for i in increasing([i for i, _ in both])]
        if not anchors:
            continue
        out += anchors
        for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)], strict=True):
            todo.append((i + 1, k, j + 1, m))
    return sorted(out)


def blocks(a: Sequence[bytes], b: Sequence[bytes], words: Sequence[int], min_words: int) -> list[tuple[int, int]]:
    """Ranges (first, last) of lines of b that an alignment with a finds as blocks."""
    out, run, held, before = [], 0, 0, None
    pairs = patience(a, b)
    for k, (i, j) in enumerate([*pairs, (-1, -1)]):
        if before is not None and (i, j) != (before[0] + 1, before[1] + 1):
            if held >= min_words:
                out.append((pairs[run][1], before[1]))
            run, held = k, 0
        held += words[j] if k < len(pairs) else 0
        before = (i, j)
    return out


def smallest_blocks(lines: Sequence[bytes], words: Sequence[int], min_words: int) -> list[tuple[bytes, int, int]]:
    """(hash, first, last) of the shortest run from each line on that holds min_words words, where there is one."""
    out, end, held = [], 0, 0
    for i, line in enumerate(lines):
        while held < min_words and end < len(lines):
            held += words[end]
            end += 1
        if held < min_words:
            break
        out.append((line if end == i + 1 else xxh3_128_digest(b"".join(lines[i:end])), i, end - 1))
        held -= words[i]
    return out


def _split(blob: bytes) -> list[bytes]:
    return [blob[i : i + 16] for i in range(0, len(blob), 16)]


def profile(docs: DataFrame, min_words: int) -> DataFrame:
    """key, all (hash of all lines), h, pos, words (of the lines that are not blank, packed), and for the smallest blocks w, s, e, and fresh: whether the document's first of that hash. docs: key, text."""

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: tuple[list, ...] = ([], [], [], [], [], [], [], [])
        for text in batch.column(1).cast(pa.binary()):
            lines = [(i, x) for i, raw in enumerate(text.as_py().split(b"\n")) if (x := raw.strip())]
            pos, h = [i for i, _ in lines], [xxh3_128_digest(x) for _, x in lines]
            words = [len(x.split(None, min_words)) for _, x in lines]
            found, seen, fresh = smallest_blocks(h, words, min_words), set(), []
            for w, _, _ in found:
                fresh.append(w not in seen)
                seen.add(w)
            blob = b"".join(h)
            for column, value in zip(out, (xxh3_128_digest(blob), blob, np.array(pos, "<i4").tobytes(), np.array(words, "<i4").tobytes(), [w for w, _, _ in found], [pos[i] for _, i, _ in found], [pos[j] for _, _, j in found], fresh), strict=True):
                column.append(value)
        kinds = (pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.bool_()))
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))], ["key", "all", "h", "pos", "words", "w", "s", "e", "fresh"])

    return arrow_map(docs.select("key", "text"), f, f"key {KEY}, all binary, h binary, pos binary, words binary, w array<binary>, s array<int>, e array<int>, fresh array<boolean>")


def aligned(pairs: DataFrame, classes: DataFrame, min_words: int) -> DataFrame:
    """(key, s, e): ranges of blocks in b of each pair (a, b)."""
    both = pairs.join(classes.select(F.col("key").alias("b"), F.col("h").alias("hb"), "pos", "words"), "b").join(classes.select(F.col("key").alias("a"), F.col("h").alias("ha")), "a")

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for ha, hb, pos, words in zip(*(batch.column(i).to_pylist() for i in range(1, 5)), strict=True):
            at = np.frombuffer(pos, "<i4")
            found.append([(int(at[i]), int(at[j])) for i, j in blocks(_split(ha), _split(hb), np.frombuffer(words, "<i4").tolist(), min_words)])
        s, e = (pa.array([[x[k] for x in r] for r in found], pa.list_(pa.int32())) for k in (0, 1))
        return pa.RecordBatch.from_arrays([batch.column(0), s, e], ["key", "s", "e"])

    rows = arrow_map(both.select("b", "ha", "hb", "pos", "words"), f, f"key {KEY}, s array<int>, e array<int>")
    return rows.select("key", F.explode(F.arrays_zip("s", "e")).alias("x")).select("key", "x.s", "x.e")


def gathered(ranges: DataFrame) -> DataFrame:
    """(key, ranges): as many as a document has blocks."""
    return ranges.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("ranges"))


def standing(shared: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows of shared, blocks of documents, that no range of their document covers."""
    inside = F.exists("ranges", lambda x: (x["s"] <= F.col("s")) & (x["e"] >= F.col("e")))
    return shared.join(ranges, "key", "left").where(F.col("ranges").isNull() | ~inside).drop("ranges")


def ranges_to_delete(docs: DataFrame, rare: int, min_words: int) -> DataFrame:
    """(key, ranges) of documents that lose lines. docs: key, text; rows may repeat."""
    rows = stored(profile(docs, min_words), "line-profile")
    columns = ("h", "pos", "words", "w", "s", "e", "fresh")
    classes = rows.where(F.size("w") > 0).groupBy("all").agg(F.min("key").alias("key"), F.min_by(F.struct(*columns), "key").alias("x"), F.count("*").alias("n"))
    classes = stored(classes.select("all", "key", "x.*", "n"), "line-classes")
    several = classes.where("n > 1").select("all", F.col("key").alias("first"))
    copies = rows.where(F.size("w") > 0).select("all", "key").join(bounded_side(several), "all").where("key <> first").select("key", F.lit(0).alias("s"), F.lit(2**31 - 1).alias("e"))

    held = classes.select("key", F.inline(F.arrays_zip("w", "s", "e", "fresh")))
    counts = held.groupBy("w").agg(F.sum(F.col("fresh").cast("long")).alias("holders"), F.count("*").alias("rows"), F.min("key").alias("first")).where("holders > 1")
    counts = stored(counts, "line-counts")
    shared = stored(join_counted(held.drop("fresh"), counts, "w", "rows").drop("rows"), "line-shared")

    few, later = shared.where(F.col("holders") <= rare), shared.where("key <> first")
    one = few.select("w", "key").distinct()
    pairs = one.join(one.withColumnRenamed("key", "a"), "w").where("a < key").select("a", F.col("key").alias("b")).distinct()
    done = stored(gathered(aligned(pairs, classes, min_words)), "line-ranges")
    left = stored(standing(later, done).select("key", "s", "e", "first", "holders"), "line-left")
    more = gathered(aligned(left.where(F.col("holders") > rare).select(F.col("first").alias("a"), F.col("key").alias("b")).distinct(), classes, min_words))
    more = stored(more, "line-ranges")
    alone = standing(left, more).select("key", "s", "e")
    flat = lambda t: t.select("key", F.inline("ranges"))
    return gathered(flat(done).unionByName(flat(more)).unionByName(alone).unionByName(copies))


def dedup_lines(docs: DataFrame, min_words: int = 10, rare: int = 16) -> DataFrame:
    """docs with text replaced, and _ld_lines, _ld_deleted added: numbers of lines before and of lines deleted."""
    docs = docs.drop(*(c for c in docs.columns if c.startswith("_ld_")))
    key = F.when(F.col("doc_id").isNotNull() & F.col("text").isNotNull(), F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("t")))
    keyed = docs.withColumn("_ld_key", key)
    found = ranges_to_delete(keyed.where("_ld_key is not null").select(F.col("_ld_key").alias("key"), "text"), rare, min_words)
    rows = keyed.join(found.select(F.col("key").alias("_ld_key"), F.col("ranges").alias("_ld_ranges")), "_ld_key", "left")
    kept = F.filter(F.split("text", "\n"), lambda _, i: ~F.exists("_ld_ranges", lambda x: i.between(x["s"], x["e"])))
    rows = rows.withColumn("_ld_kept", F.when(F.col("_ld_ranges").isNotNull(), kept)).withColumn("_ld_lines", lines_of("text"))
    gone = F.coalesce(F.col("_ld_lines") - F.size("_ld_kept"), F.lit(0)).cast("long")
    text = F.when(F.col("_ld_kept").isNotNull(), F.array_join("_ld_kept", "\n")).otherwise(F.col("text"))
    return rows.select(*(text.alias(c) if c == "text" else c for c in docs.columns), "_ld_lines", F.when(F.col("_ld_kept").isNull(), 0).otherwise(gone).cast("long").alias("_ld_deleted"))


def lines_of(text: str) -> Column:
    """Number of lines; 0 for null."""
    return F.coalesce(F.length(text) - F.length(F.translate(text, "\n", "")) + 1, F.lit(0)).cast("long")
