"""From raw documents to token ids in five stages, each written as Parquet and read again by the next.

Every stage works on all that its predecessor kept. All but the last return the columns of documents: doc_id, text, lang, source, n_chars.
Documents without an id pass the line and copy filters as they are; a document whose lines were all deleted is dropped. Null, empty and blank texts are rejected by the first stage. Very long texts are read
whole by every stage. Rows that repeat id and text are one document: they stay or go together, and all of them stay where that document does. Of an id with several texts all rows stay or go with the group that
any of them belongs to. Columns beyond those of documents are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import jaccard, line_dedup, mixing, pieces, weak_quality
from ledgerloom.llm.common import release, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def tokenizer_path() -> str:
    """The public model's file: PIECE_MODEL, or the one of the installed package."""
    if found := os.environ.get("PIECE_MODEL"):
        return found
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# Domains are groups of sources by a hash. Each domain weighs the same, whatever it holds; within one, languages have weights of
# their own ('*' stands for any name), and the sources of a language weigh the same, so that large ones leave room for small ones.
DOMAINS = 4
WEIGHTS = {("*",): 1.0, ("*", "en"): 5.0, ("*", "de"): 2.0, ("*", "fr"): 2.0, ("*", "*"): 1.0, ("*", "*", "*"): 1.0}


def levels() -> list:
    return [F.concat(F.lit("domain"), F.pmod(F.xxhash64("source"), F.lit(DOMAINS)).cast("string")), "lang", "source"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    return weak_quality.keep_good(docs, weak_quality.train(docs))


def delete_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(docs.select(*COLUMNS))
    left = rows.where("_ld_deleted = 0 or btrim(text) <> ''")
    return left.withColumn("n_chars", F.when(F.col("_ld_deleted") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(docs, k=5, num=4, den=5)
    copies = found.where("component_id <> doc_id").select("doc_id")
    return docs.select(*COLUMNS).join(copies, "doc_id", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs.select(*COLUMNS), levels(), WEIGHTS, budget_share=1.0, max_epochs=2).select(*COLUMNS)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, pieces.load_model(tokenizer_path()), ["doc_id", "lang", "source"])


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", delete_lines),
    ("n-gram Jaccard join", keep_one_of_each),
    ("mixing sources", mix_sources),
    ("SentencePiece encoding", to_pieces),
]
#: The classifier is trained and pieces are searched, which SQL cannot express. Tests hold every stage against brute force over what its predecessor kept.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{i}")
            release(spark, docs)
    return docs
