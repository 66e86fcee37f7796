"""The operators of this package over the driver's tables, and their SQL where SQL has the means."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regua.llm import (
    bloom_lm,
    byte_bpe,
    covering_simhash,
    decontaminate,
    deobfuscate,
    ga2m_quality,
    importance,
    language_birnn,
    radix_dedup,
    suffix_dedup,
    superkmer_dedup,
    token_dp,
    whitening,
)
from regua.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return bloom_lm.lm_scores(read(spark, sf, "documents"))


def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def op3_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return byte_bpe.digests(read(spark, sf, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf, "documents"))


def op5_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return radix_dedup.exact_duplicates(read(spark, sf, "documents"))


def op6_language(spark: SparkSession, sf: str) -> DataFrame:
    return language_birnn.languages(read(spark, sf, "documents"))


def op7_superkmer_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return superkmer_dedup.remove_passages(read(spark, sf, "documents"))


def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_dp.token_counts(read(spark, sf, "documents"))


def op9_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return covering_simhash.near_duplicates(read(spark, sf, "documents"))


def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    return ga2m_quality.quality_scores(read(spark, sf, "documents"), read(spark, sf, "labels"))


def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(read(spark, sf, "embeddings"))


def op12_importance(spark: SparkSession, sf: str) -> DataFrame:
    return importance.importance(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def op13_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return deobfuscate.personal_data(read(spark, sf, "documents"))


QUERIES: dict[str, Query] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_decontamination": op2_decontamination,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_language": op6_language,
    "op7_superkmer_dedup": op7_superkmer_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_simhash": op9_simhash,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_importance": op12_importance,
    "op13_personal_data": op13_personal_data,
}
