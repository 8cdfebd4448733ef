"""The registered queries of this subpackage: opN_<name>, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import byte_bpe, decontaminate, license_scan, lm_scoring, manifest, mixing, quality_knn, quality_rules, simhash, spelling, token_files, toxicity, url_filter
from tidewatch.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.op1_lm_scoring(read_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op2_simhash(read_table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.op3_url_filter(read_table(spark, sf_dir, "pages"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.op4_token_files(read_table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op5_mixing(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.op6_quality_rules(read_table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op7_decontaminate(read_table(spark, sf_dir, "documents"),
                                           read_table(spark, sf_dir, "benchmark"))


def op8_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.op8_quality_knn(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op9_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.op10_license_scan(read_table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.op11_byte_bpe(read_table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.op12_spelling(read_table(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.op13_manifest(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_lm_scoring, op2_simhash, op3_url_filter, op4_token_files, op5_mixing, op6_quality_rules, op7_decontaminate,
    op8_quality_knn, op9_toxicity, op10_license_scan, op11_byte_bpe, op12_spelling, op13_manifest)}

ORACLE: dict[str, str] = {"op7_decontaminate": decontaminate.OP7_SQL, "op12_spelling": spelling.OP12_SQL, "op13_manifest": manifest.OP13_SQL}
