"""Registered queries of the training-text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickforge.catalog import query
from tickforge.llm import collocations, decontamination, exact_dedup, fingerprints, html_extract, language_id, lm_scoring, mixing, ngram_join, resampling, secret_scan, token_counts, toxicity


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op8_exact_dedup", exact_dedup.ORACLE)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.query(documents(spark, sf_dir))


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.query(documents(spark, sf_dir))


@query("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.query(documents(spark, sf_dir))


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.query(documents(spark, sf_dir))


@query("op5_lm_scoring")
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.query(documents(spark, sf_dir))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.query(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op9_html_extract")
def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.query(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op3_mixing")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.query(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op1_ngram_join")
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.query(documents(spark, sf_dir))


@query("op13_fingerprints")
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.query(documents(spark, sf_dir))


@query("op12_resampling")
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.query(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op11_collocations", collocations.ORACLE)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.query(documents(spark, sf_dir))
