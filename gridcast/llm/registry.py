"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridcast.llm import align, ann, collocations, ctw, decontam, langid, mixing, near_dedup, packing, paragraphs, quality, secret_scan, separators
from gridcast.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op2_temperature_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.report(table(spark, sf, "documents"))


def op3_context_tree_scores(spark: SparkSession, sf: str) -> DataFrame:
    return ctw.report(table(spark, sf, "documents"))


def op4_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.report(table(spark, sf, "documents"))


def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op6_adaptive_scan(spark: SparkSession, sf: str) -> DataFrame:
    return ann.report(table(spark, sf, "embeddings"))


def op7_paragraph_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return paragraphs.report(table(spark, sf, "documents"))


def op8_separator_scan(spark: SparkSession, sf: str) -> DataFrame:
    return separators.report(table(spark, sf, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


def op10_language_fusion(spark: SparkSession, sf: str) -> DataFrame:
    return langid.report(table(spark, sf, "pages"), table(spark, sf, "documents"))


def op11_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return align.report(table(spark, sf, "documents"))


def op12_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.report(table(spark, sf, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.report(table(spark, sf, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_decontamination, op2_temperature_mixing, op3_context_tree_scores, op4_minhash_near_dedup, op5_quality_rules,
    op6_adaptive_scan, op7_paragraph_dedup, op8_separator_scan, op9_best_fit_packing, op10_language_fusion, op11_tokenizer_alignment,
    op12_secret_scan, op13_phrase_collocations)}
SQL: dict[str, str] = {"op1_decontamination": decontam.REPORT_SQL, "op2_temperature_mixing": mixing.REPORT_SQL,
                       "op4_minhash_near_dedup": near_dedup.REPORT_SQL, "op12_secret_scan": secret_scan.REPORT_SQL,
                       "op13_phrase_collocations": collocations.REPORT_SQL}
