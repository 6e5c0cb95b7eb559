"""Corpus pipeline: documents in, token ids out, one dealt operator per stage.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it to
the shared folder as Parquet and hands the written rows to the next stage. All
but the last return the columns of ``documents``.

Defined results: rows with null or empty text pass every stage that looks for
copies or benchmark passages, and are judged by the classifier like others; an
empty table stays empty; repeated rows with words leave the near-duplicate stage once.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, decontam, neardup, quality_fm, suffix_index
from strata.llm.common import release, stage
from strata.llm.queries import RANKS
from strata.sources.tables import read_table

#: Documents scored below this are rejected by the classifier.
LEAST_QUALITY = 0.3


#: Rows of an Arrow batch between Spark and Python (10,000 texts of 2 kB and more fill a worker's memory).
BATCH_ROWS = 1000
#: Up to this many rejected rows (about 30 bytes each) their names are broadcast.
BROADCAST_ROWS = 300_000


def _small_batches(spark: SparkSession) -> None:
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """docs without the rows named by (doc_id, th): whole rows stay in the JVM, only names were in Python."""
    gone = stage(rejected.select(F.col("doc_id").alias("gone_id"), F.col("th").alias("gone_th")).distinct(), "rejected")
    small = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    same = docs["doc_id"].cast("long").eqNullSafe(small["gone_id"]) & (F.xxhash64(docs["text"]) == small["gone_th"])
    return docs.join(small, same, "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Factorisation machine learned from the labelled documents; rejected documents go."""
    _small_batches(spark)
    machine = quality_fm.fit(docs, read_table(spark, sf_dir, "labels"))
    return _without(docs, quality_fm.scores(docs, machine).where(F.col("score") < LEAST_QUALITY))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8: one document of each group stays."""
    _small_batches(spark)
    return neardup.one_per_group(docs, neardup.Settings())


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every byte within a string of 200 bytes that also starts elsewhere is cut out."""
    _small_batches(spark)
    return suffix_index.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit budget go."""
    _small_batches(spark)
    return _without(docs, decontam.holders(docs, read_table(spark, sf_dir, "benchmark")))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every text, with the digests of the ids and of the bytes they decode to."""
    _small_batches(spark)
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    # written between the two, so that a task has one Python worker and not one for each direction
    ids = stage(bpe.encode(docs.select("doc_id", "text"), path, pattern).drop("text"), "token-ids")
    coded = bpe.decode(ids, path, pattern)
    return coded.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_classifier", quality),
    ("near_duplicates", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("decontamination", decontamination),
    ("byte_bpe", token_ids),
]

#: SQL can't express the stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
        if before is not None:
            release(before)  # what the last stage read is used up
        before = docs
    return docs
