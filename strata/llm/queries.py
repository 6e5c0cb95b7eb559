"""Registered queries of the dealt operators: thin digests over the operators' outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    bpe, chaining, decontam, hard_negatives, html_extract, langid, metric_join, neardup, quality_fm, repetition, sharding, suffix_index,
    turn_trie,
)
from strata.llm.common import held_out
from strata.sources.tables import read_table

SHARDS = 24
#: Rows that one task numbers, about; the number of buckets of a shard follows from it.
SLOT_ROWS = 50_000
RANKS = "byte_bpe_50k.tiktoken"


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = sharding.jump_shard(docs, F.col("doc_id"), SHARDS)
    buckets = 8 + docs.count() // (SHARDS * SLOT_ROWS)
    out = sharding.number_slots(placed, "shard", ["doc_id", "text_crc32", "size"], buckets)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return bpe.digests(spark, docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.pages_text(read_table(spark, sf_dir, "pages"))


def op4_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = neardup.near_duplicates(docs, neardup.Settings(words=3, num=85, den=100))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held = held_out(F.col("doc_id"), 5, 0)
    machine = quality_fm.fit(docs.where(~held), read_table(spark, sf_dir, "labels"))
    scored = quality_fm.score(docs, machine)
    return scored.select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.matches(docs, read_table(spark, sf_dir, "benchmark"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_index.digests(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return repetition.measure(docs).drop("text").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_covered", "longest_repeat", "covered_share",
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = held_out(F.col("doc_id"), 3, 1)
    model = langid.fit(docs.where(~held))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.summary(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return metric_join.jaccard_components(docs, neardup.Settings(words=5, num=80, den=100))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.vectors(read_table(spark, sf_dir, "embeddings"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_trie.rebuilt_trie(read_table(spark, sf_dir, "conversations"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding, op2_byte_bpe, op3_html_extraction, op4_minhash_neardup, op5_quality_classifier,
        op6_benchmark_decontamination, op7_suffix_array_dedup, op8_quality_rules, op9_language_id, op10_substring_dedup,
        op11_jaccard_join, op12_hard_negatives, op13_conversation_trie,
    )
}
