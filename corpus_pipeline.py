"""The corpus pipeline: five stages over ``documents``, each written and read again by the next.

Language ID, line dedup, near-duplicate removal, benchmark decontamination, packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from engrama.llm import decontam, lang_id, line_dedup, near_dup, packing
from engrama.session import ship_package, work_dir

NEAR_DUP_THRESHOLD = 80  # percent of shared five-word shingles; op2's own is 85

def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without a letter or far from every prototype go."""
    ship_package(spark)
    return lang_id.keep_known_languages(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut out; n_chars follows the text."""
    return line_dedup.drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship_package(spark)
    return near_dup.drop_near_duplicates(docs, NEAR_DUP_THRESHOLD)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    ship_package(spark)
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, with their places in packed sequences."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]
ORACLE_SQL = None  # models, similarity and packing aren't SQL; tests compare each stage with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written below the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = work_dir(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
