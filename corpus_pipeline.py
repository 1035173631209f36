"""From raw documents to packed training batches: five stages, each one operator over all that the stage before kept.

Every stage is written as Parquet to the shared folder and read again, so a lost executor costs a stage at most.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almsbook.llm import decontaminate, language_id, length_buckets, line_templates, simhash
from almsbook.sources.storage import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language stays in doubt, go."""
    return language_id.keep_identified(docs, language_id.fit(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, but for the first document of each; ``n_chars`` follows the text."""
    kept = line_templates.drop_lines(docs)
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their bucket, batch and padding."""
    return length_buckets.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("decontamination", remove_benchmarks),
    ("packing", pack_batches),
]

# Tokenizers, XXH64 and the boundaries by dynamic programming are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
