"""Grouping of spelling variants: words that differ by one inserted, deleted or replaced code point, found by an even-partition pigeonhole join.

A word of length l is cut into two segments, its first l // 2 code points and the rest. One edit leaves one of the two as it is, so a word that is as long as another
or one longer holds one of the other's segments: the first at its own beginning, the second at its own end, that is, shifted by the difference of lengths.

1. Words are counted: runs of letters of each document, edited as asked, those of a batch summed in Python, all of them by Spark.
2. Index: two rows a word, (length, side, segment). Probes: four rows a word, its beginnings and ends as segments of words of its length and of one less.
3. Candidates are verified: beside the shared segment the rest must differ by one edit (Spark's own edit distance, bounded by one). Pairs that share both sides arise twice and are taken once.
4. A segment that more than ``common`` words hold would make pairs by the square. There the rest is looked up by what is left of it when one code point goes, together with its
   place (an edited pair of equal lengths loses the same place, of unequal lengths the longer one loses a place). The alphabet has 90 letters, so such a key has that many words at most, whatever the group. This is exact.
5. The form of a word is the near word with the largest count, ties to the smallest, if it occurs ``ratio`` times as often or more. Roots follow forms by pointer jumping, in as many rounds as the logarithm of the longest chain.

Null texts hold no words; a null id counts as an empty string; runs of any length and very long texts are read whole; rows that repeat are counted as often as they stand; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import PART_ROWS, bounded_side, drop, give_back, join_counted, stored, texts

# Fixed value: letters A-Z, a-z and U+00C0 to U+00FF, in UTF-8.
_RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
# Different words of a batch that are held before they are handed on.
_HELD = 100_000


def one_letter_lost(doc_id: bytes, run: bytes, one_in: int = 97) -> bytes:
    """The run without one code point where the checksum of id and run says so; which one, it says too."""
    h = zlib.crc32(doc_id + b":" + run)
    if h % one_in:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(docs: DataFrame, edit: Callable[[bytes, bytes], bytes] | None = None, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """(word, n): runs of letters, lower-cased A to Z, of min_length code points and min_count occurrences or more. edit: (id, run) -> run, applied before counting."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for at in range(0, batch.num_rows, PART_ROWS):
                part = batch.slice(at, PART_ROWS)
                for doc_id, text in zip(texts(part.column(0)), part.column(1).cast(pa.binary()), strict=True):
                    for run, n in Counter(_RUN.findall((text.as_py() or b"").lower())).items():
                        word = edit(doc_id or b"", run) if edit else run
                        if len(word) >= min_length and (len(word) >= 2 * min_length or len(word.decode()) >= min_length):
                            counts[word] += n
                    if len(counts) >= _HELD:
                        yield out()
        yield out()
        give_back()

    rows = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _sides(word: Column, length: Column) -> Column:
    """Array of (l, side, segment, rest): the segments that a word holds of words of that length."""
    own, half = F.length(word), F.floor(length / 2).cast("int")
    first = F.struct(length.alias("l"), F.lit(0).alias("side"), F.substring(word, F.lit(1), half).alias("segment"), F.substring(word, half + 1, own).alias("rest"))
    tail = length - half
    return F.array(first, F.struct(length.alias("l"), F.lit(1).alias("side"), F.substring(word, own - tail + 1, tail).alias("segment"), F.substring(word, F.lit(1), own - tail).alias("rest")))


def _losses(rest: Column, place: bool) -> Column:
    """What is left of a string without each of its code points; with place, together with where it was."""
    gone = F.transform(F.sequence(F.lit(1), F.length(rest)), lambda i: F.concat(*([i.cast("string"), F.lit(":")] if place else []), F.substring(rest, F.lit(1), i - 1), F.substring(rest, i + 1, F.length(rest))))
    return F.when(F.length(rest) > 0, F.array_distinct(gone)).otherwise(F.array().cast("array<string>"))


def near_pairs(words: DataFrame, common: int = 64) -> DataFrame:
    """(a, b): words that differ by one edit, each pair once, in either order. words: (word), distinct."""
    w, own = F.col("word"), F.length("word")
    index = stored(words.select("word", F.inline(_sides(w, own))), "spelling-index")
    longer = words.where(own > 1).select("word", F.inline(_sides(w, own - 1)))
    key = ["l", "side", "segment"]
    sizes = stored(index.groupBy(*key).agg(F.count("*").alias("n")), "spelling-segments")
    tag = lambda t: t.withColumn("k", F.xxhash64(*key))
    hot = stored(tag(sizes.where(F.col("n") > common)).groupBy("k").agg(F.sum("n").alias("n")), "spelling-hot")

    def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = tag(rows)
        return rows.join(bounded_side(hot.select("k")), "k", "left_anti"), join_counted(rows, hot, "k", "n").drop("n")

    (few, many), (few_longer, many_longer) = split(index), split(longer)
    near = lambda t: t.where(F.levenshtein("rest", "rest_b", 1) == 1)
    as_b = lambda t: t.select(*key, F.col("word").alias("b"), F.col("rest").alias("rest_b"))
    pairs = near(few.join(as_b(few), key).where("word < b")).select(F.col("word").alias("a"), "b")
    pairs = pairs.unionByName(near(few.join(as_b(few_longer), key)).select(F.col("word").alias("a"), "b"))

    # Common segments: the rest of both, less one code point, is a key that few words have.
    lost = lambda t, place: t.select(*key, "word", F.explode(_losses(F.col("rest"), place)).alias("left"))
    same = lost(many, True)
    pairs = pairs.unionByName(same.join(same.withColumnRenamed("word", "b"), [*key, "left"]).where("word < b").select(F.col("word").alias("a"), "b"))
    whole = many.select(*key, "word", F.col("rest").alias("left"))
    pairs = pairs.unionByName(whole.join(lost(many_longer, False).withColumnRenamed("word", "b"), [*key, "left"]).select(F.col("word").alias("a"), "b"))
    return pairs.distinct()


def variants(counts: DataFrame, ratio: int = 2, common: int = 64) -> DataFrame:
    """(word, form, root, n, n_near, form_n). counts: (word, n), a word once."""
    counts = stored(counts.select("word", "n"), "spelling-words")
    pairs = near_pairs(counts.select("word"), common)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    best = both.join(counts.select(F.col("word").alias("b"), "n"), "b").groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), F.col("b").alias("word"))).alias("best"))
    rows = counts.join(best, "word", "left")
    wins = F.coalesce(-F.col("best.n") >= ratio * F.col("n"), F.lit(False))
    rows = rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(wins, F.col("best.word")).alias("form"), F.when(wins, -F.col("best.n")).alias("form_n"))
    rows = stored(rows, "spelling-forms")
    roots = roots_of(rows.where("form is not null").select("word", F.col("form").alias("root")))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots_of(parents: DataFrame) -> DataFrame:
    """(word, root) from (word, root) with each word's parent: words without a row are roots. Counts grow along a chain, so there is no cycle."""
    now = stored(parents, "spelling-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        nxt = stored(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        drop(now)
        now = nxt.select("word", "root")
        now.stored_at = nxt.stored_at
        if not nxt.where("moved").limit(1).count():
            return now
