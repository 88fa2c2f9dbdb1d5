"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.llm import decontaminate, line_dedup, mixing, ngram_jaccard, quality_rules
from ticketflow.llm.text import cut_lineage, read

# Fixed by the contract of the near-duplicate stage: words in a shingle, least similarity in percent.
SHINGLE_WORDS = 5
SIMILARITY = 80


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    trusted = quality_rules.trusted_ids(read(spark, sf_dir, "labels"))
    return quality_rules.quality_rules(docs, trusted).filter("kept").select(*docs.columns)


def apply_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stay in another one; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs)
    changed = kept.withColumn("text", F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", F.when(F.col("n_dropped") > 0, length).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def apply_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates."""
    return ngram_jaccard.keep_one(docs, SHINGLE_WORDS, SIMILARITY)


def apply_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def apply_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where in training each document stands and how many of its words are taken."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality_rules", apply_quality_rules),
    ("line_dedup", apply_line_dedup),
    ("ngram_jaccard", apply_near_dedup),
    ("decontamination", apply_decontamination),
    ("mixing", apply_mixing),
]

# Hashed n-grams and tilings have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
