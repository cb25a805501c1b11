"""The registered queries of the operators, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, decontaminate, html_text, language, lm, near_dup, oracle, phrases, pieces, pii, quality, shards, simhash, urls
from .common import table

#: Fixed values of the URL query: host, path, allow.
URL_RULES = [urls.Rule("net", "/", False), urls.Rule("example.net", "/en/", True),
             urls.Rule("example.com", "/de/", False), urls.Rule("org", "/fr/", True)]


def op1_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(table(spark, sf_dir, "documents"), n_shards=40)


def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.pieces_report(table(spark, sf_dir, "documents"))


def op3_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op4_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op5_text_to_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.pages_report(table(spark, sf_dir, "pages"))


def op6_redirect_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op7_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_maximum_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_report(table(spark, sf_dir, "documents"))


def op9_partial_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(table(spark, sf_dir, "documents"))


def op10_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op11_arrow_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(table(spark, sf_dir, "documents"))


def op12_general_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_double_array_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_sampled_splitters, op2_sentence_pieces, op3_odd_sketches, op4_quality_cascade, op5_text_to_tag,
        op6_redirect_classes, op7_benchmark_windows, op8_maximum_entropy, op9_partial_matching, op10_disclosure,
        op11_arrow_alignment, op12_general_pigeonhole, op13_double_array_tries)}

SQL: dict[str, str] = {
    "op3_odd_sketches": oracle.NEAR_DUPLICATES,
    "op4_quality_cascade": oracle.QUALITY,
    "op6_redirect_classes": oracle.URLS,
    "op7_benchmark_windows": oracle.CONTAMINATION,
    "op13_double_array_tries": oracle.COLLOCATIONS,
}
