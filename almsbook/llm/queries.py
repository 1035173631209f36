"""The registered queries of this package and their SQL, where SQL can express them."""

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from almsbook.llm import (
    decontaminate, filter_audit, html_extract, language_id, length_buckets, license_scan, line_templates, lm_score, nn_descent, seed_extend,
    simhash, token_records, whitening,
)
from almsbook.llm.common import table


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.digest(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.digest(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.digest(table(spark, sf_dir, "documents"))


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.digest(table(spark, sf_dir, "documents"))


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.digest(table(spark, sf_dir, "embeddings"))


def op7_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_extend.digest(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(table(spark, sf_dir, "documents"))


def op9_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_buckets.pack(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest(table(spark, sf_dir, "embeddings"))


def op13_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_records, op2_language_id, op3_license_scan, op4_lm_score, op5_line_templates, op6_nn_descent, op7_seed_extend,
        op8_simhash, op9_length_buckets, op10_decontaminate, op11_filter_audit, op12_whitening, op13_html_extract,
    )
} | {"pipeline": corpus_pipeline.run}

SQL: dict[str, str] = {"op5_line_templates": line_templates.SQL, "op7_seed_extend": seed_extend.SQL, "op11_filter_audit": filter_audit.SQL}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
