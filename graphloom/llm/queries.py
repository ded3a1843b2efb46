"""Registered queries of the training-data operators: each applies its operator, with
production parameters, to its whole table. Their DuckDB SQL is in ``oracle.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from graphloom.llm.common import table
from graphloom.llm.decontaminate import leak_report
from graphloom.llm.jaccard import jaccard_report
from graphloom.llm.langid import language_report
from graphloom.llm.licenses import license_report
from graphloom.llm.lines import line_report
from graphloom.llm.mix import mix_report
from graphloom.llm.near import near_report
from graphloom.llm.negatives import negative_report
from graphloom.llm.runs import run_report
from graphloom.llm.secrets import secret_report
from graphloom.llm.shard import shard_report
from graphloom.llm.topk import top_k
from graphloom.llm.toxicity import toxicity_report


def op1_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op3_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op4_line_edit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op5_shard_minimax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_report(table(spark, sf_dir, "documents"))


def op6_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents"))


def op8_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op9_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


def op10_minhash_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_report(table(spark, sf_dir, "documents"))


def op11_segment_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negative_report(table(spark, sf_dir, "embeddings"))


def op12_count_tree_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_report(table(spark, sf_dir, "documents"))


def op13_run_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ordinal_toxicity, op2_mix_sources, op3_secret_ledger, op4_line_edit_dedup, op5_shard_minimax, op6_template_leaks,
        op7_kneser_ney_language, op8_pivot_top_k, op9_license_digests, op10_minhash_near, op11_segment_negatives,
        op12_count_tree_jaccard, op13_run_diagonals,
    )
}
