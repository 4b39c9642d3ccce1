"""Corpus pipeline: quality rules, near-duplicate removal, benchmark
decontamination, secret redaction and packing, one after the other.

Every stage works on all rows that its predecessor kept.  All but the last
return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenalytics.llm.common import materialize, read_table, small_batches
from arenalytics.llm.decontaminate import decontaminate
from arenalytics.llm.minhash import keep_one_each
from arenalytics.llm.packing import pack_documents
from arenalytics.llm.quality import keep_good
from arenalytics.llm.secrets import redact_secrets

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the n-gram ratio."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    small_batches(spark)
    return keep_one_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    small_batches(spark)
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a placeholder, n_chars to match."""
    out = redact_secrets(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 4096 tokens."""
    small_batches(spark)
    return pack_documents(docs, TOKENIZER)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("secret_scan", secret_scan),
          ("packing", packing)]

# Near-duplicate components, models and packing are iterative: no SQL.  The
# tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
