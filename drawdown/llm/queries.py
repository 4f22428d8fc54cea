"""One query per text operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from drawdown.llm import (
    bagminhash,
    chat,
    decontaminate,
    hard_negatives,
    hpy_lm,
    langid,
    line_dedup,
    mixing,
    oracles,
    packing,
    quality_rules,
    suffix_dedup,
    token_store,
    whitening,
)
from drawdown.llm.encoding import public_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_hpy_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpy_lm.report(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.members(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op5_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.report(table(spark, sf_dir, "documents"))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.report(table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"), "word", 2)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"), "byte", 0)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(table(spark, sf_dir, "conversations"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    found = (
        op1_quality_rules,
        op2_hpy_lm,
        op3_line_dedup,
        op4_suffix_dedup,
        op5_bagminhash,
        op6_token_store,
        op7_packing,
        op8_decontaminate,
        op9_chat,
        op10_langid,
        op11_hard_negatives,
        op12_mixing,
        op13_whitening,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
