"""Registered queries of the operators for training data, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskpanel.llm import (
    bpe,
    chat,
    decontaminate,
    filter_audit,
    html_extract,
    jaccard,
    lm_score,
    packing,
    pii,
    quality,
    resample,
    substring,
    suffix,
)


def _over(table: str, report: Callable[[DataFrame], DataFrame]):
    """A query that applies ``report`` to one whole table."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(spark.read.parquet(f"{sf_dir}/{table}.parquet"))
    return query


def _contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                                      spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                          spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                              spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampled(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                              spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": _over("pages", html_extract.extract),
    "op2_bpe": _over("documents", bpe.digests),
    "op3_jaccard_join": _over("documents", jaccard.report),
    "op4_decontamination": _contaminated,
    "op5_lm_score": _scores,
    "op6_substring_dedup": _over("documents", substring.substring_report),
    "op7_pii": _over("documents", pii.report),
    "op8_suffix_dedup": _over("documents", suffix.report),
    "op9_quality_rules": _over("documents", quality.quality_report),
    "op10_chat_format": chat.query,
    "op11_filter_audit": _audit,
    "op12_importance_resampling": _resampled,
    "op13_best_fit_packing": _over("documents", packing.report),
}

ORACLES: dict[str, str] = {
    "op1_html_extraction": html_extract.report_sql(),
    "op3_jaccard_join": jaccard.report_sql(),
    "op6_substring_dedup": substring.report_sql(),
    "op9_quality_rules": quality.report_sql(),
    "op10_chat_format": chat.report_sql(),
    "op11_filter_audit": filter_audit.report_sql(),
}
