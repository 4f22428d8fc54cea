"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, benchmark decontamination, packing.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet and read again as the next
stage's documents. All but the last return the columns of documents. `labels` and `benchmark` come from `sf_dir`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drawdown.llm import bagminhash, decontaminate, line_dedup, packing, quality_rules
from drawdown.llm.encoding import public_path
from drawdown.llm.queries import table
from drawdown.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base rule or a certified rule rejects go."""
    return quality_rules.keep(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line, or nearly do, go from the texts, and with its last line a document; `n_chars` follows."""
    out = line_dedup.dedup(docs, emptied=False)
    if "n_chars" in out.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return bagminhash.dedup(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left and their places in sequences of 2048 tokens."""
    return packing.pack(docs, public_path("byte_bpe_50k.json"), "byte", 0)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmarks),
    ("packing", pack),
]

#: Binomial tails, near-duplicate classes and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
