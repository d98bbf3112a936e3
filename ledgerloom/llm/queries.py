"""Queries over the driver's tables, one for each operator, at production parameters and over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import archives, conversations, exact_dedup, impact_search, jaccard, line_dedup, mixing, pieces, pii, rule_ledger, spelling, toxicity, weak_quality
from ledgerloom.llm.common import stored, table, word_count
from ledgerloom.llm.oracles import ORACLE_SQL


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.col("_ld_lines").alias("n_lines"), F.col("_ld_deleted").alias("n_deleted"), F.length("text").cast("long").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), pieces.load_model(corpus_pipeline.tokenizer_path()))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(table(spark, sf_dir, "documents"), corpus_pipeline.levels(), corpus_pipeline.WEIGHTS, budget_share=0.6)
    return rows.select("doc_id", F.col("_mix_epoch").alias("epoch"), F.col("_mix_leaf").alias("leaf"), word_count("text").alias("n_tokens"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(rule_ledger.ledger(table(spark, sf_dir, "documents")), "ledger")
    rows = rule_ledger.verdicts(rule_ledger.apply_policy(rows))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_bits", *(f"kept_v{v}" for v in rule_ledger.POLICIES), "only_rule")


def quality_rules_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule does under the latest policy, from the ledger's bits."""
    return rule_ledger.ablations(stored(rule_ledger.ledger(table(spark, sf_dir, "documents")), "ledger"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.spans(table(spark, sf_dir, "documents")))


def pii_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base kinds of op9 alone, which SQL can express."""
    return pii.base_digest(pii.spans(table(spark, sf_dir, "documents")))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return weak_quality.score(docs, weak_quality.train(docs))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents"), spelling.one_letter_lost))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.audits(conversations.damaged(rows), rows)


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_groups(table(spark, sf_dir, "documents"), digest_all=True)
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_toxicity, op2_line_dedup, op3_topk, op4_sentencepiece, op5_warc, op6_mixing, op7_quality_rules, op8_ngram_jaccard, op9_pii, op10_quality_classifier, op11_spelling_variants, op12_conversation_repair, op13_exact_dedup, quality_rules_ablations, pii_base_spans)}
QUERIES["pipeline"] = corpus_pipeline.run

__all__ = ["ORACLE_SQL", "QUERIES"]
