"""From raw documents to token ids: five stages, each on all that the one before kept.

Defined results: a null text is scored as an empty one, equals empty texts in both
deduplications, holds no test item and has no tokens; rows without an id lose every tie for the row
that stays, and one of them stays where there is no other; repeated rows are copies of each
other; empty tables give no rows (without labels every document has one score); columns beyond those of
documents are kept up to the last stage, which returns ids and digests beside doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regua.llm import byte_bpe, covering_simhash, decontaminate, ga2m_quality, radix_dedup
from regua.llm.common import read, store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return ga2m_quality.keep_good(docs, ga2m_quality.train(docs, read(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return radix_dedup.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints, the row with the smallest id."""
    return covering_simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a test item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and digests of the ids and of what they decode to."""
    return byte_bpe.encoded(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte-level bpe", tokens),
]

#: Neither the fitted classifier nor the fingerprints can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what a stage returns is stored before the next one reads it."""
    docs = read(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = store(docs, name.replace(" ", "_"))
    return docs
