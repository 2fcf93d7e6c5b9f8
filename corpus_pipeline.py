"""From raw documents to packed token sequences: quality rules, near duplicates, repeated substrings, benchmark
passages, packing. Each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storeglass.llm import decontaminate, neardup, packing, quality, substrings
from storeglass.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the thresholds of their language and source."""
    return quality.filter_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group linked by 5-word shingles at 0.8 or more."""
    return neardup.filter_documents(docs, words=5, least=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that a document with a smaller id has too; documents that vanish are gone."""
    return substrings.cut_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, up to one edit in twenty characters."""
    return decontaminate.filter_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents and their places in sequences of 1024."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_dedup),
    ("repeated substrings", substring_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Near duplicates, suffix arrays, edit matching and tokens are beyond SQL; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
