"""The corpus pipeline: documents in, a deduplicated, decontaminated and mixed sample out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.llm.decontamination import drop_leaks
from tidemark.llm.exact_dedup import drop_exact_duplicates
from tidemark.llm.language_id import drop_unrecognised
from tidemark.llm.simhash_dedup import drop_near_duplicates
from tidemark.llm.source_mixing import mixed_sample
from tidemark.sinks.storage import shared_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language; the model is learned from all rows that name theirs."""
    return drop_unrecognised(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest id."""
    return drop_exact_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return drop_near_duplicates(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with raked weights of sources, languages and topics; adds topic, tokens, weight and probability."""
    return mixed_sample(docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("simhash_dedup", near_copies),
    ("decontamination", leaks),
    ("source_mixing", mixture),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What the others keep is written below the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
