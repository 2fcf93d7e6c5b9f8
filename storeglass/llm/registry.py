"""The queries of this subpackage: one per operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from storeglass.llm import (
    align, attention, binary, classify, decontaminate, licenses, neardup, oracles, packing, quality, substrings, urls, variants)
from storeglass.llm.common import table


def op4_shortest_pack_first(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack_documents(table(spark, root, "documents"))


def op1_edit_matching(spark: SparkSession, root: str) -> DataFrame:
    return decontaminate.find(table(spark, root, "documents"), table(spark, root, "benchmark"))


def op2_chosen_path(spark: SparkSession, root: str) -> DataFrame:
    return neardup.groups(table(spark, root, "documents"), words=3, least=85)


def op3_toxicity(spark: SparkSession, root: str) -> DataFrame:
    return classify.toxicity(table(spark, root, "documents"), table(spark, root, "labels"))


def op5_language(spark: SparkSession, root: str) -> DataFrame:
    return classify.language(table(spark, root, "documents"))


def op6_license_scan(spark: SparkSession, root: str) -> DataFrame:
    return licenses.scan(table(spark, root, "documents"))


def op7_path_templates(spark: SparkSession, root: str) -> DataFrame:
    return urls.judge(table(spark, root, "pages"))


def op8_suffix_arrays(spark: SparkSession, root: str) -> DataFrame:
    return substrings.deduplicate(table(spark, root, "documents"))


def op9_packed_matrices(spark: SparkSession, root: str) -> DataFrame:
    return binary.pack_matrices(table(spark, root, "documents"))


def op10_adaptive_quality(spark: SparkSession, root: str) -> DataFrame:
    return quality.assess(table(spark, root, "documents"))


def op11_interval_coalescing(spark: SparkSession, root: str) -> DataFrame:
    return align.align(table(spark, root, "documents"))


def op12_attention_quality(spark: SparkSession, root: str) -> DataFrame:
    return attention.quality(table(spark, root, "documents"), table(spark, root, "labels"))


def op13_fm_index_variants(spark: SparkSession, root: str) -> DataFrame:
    return variants.group_variants(table(spark, root, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: query for name, query in globals().items() if name.startswith("op")}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
