"""The registered queries of the operators and the SQL that the expressible ones must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    centroid_clustering,
    decontamination,
    exact_dedup,
    language_id,
    lm_scoring,
    oracles,
    secret_scan,
    simhash_dedup,
    source_mixing,
    substring_dedup,
    toxicity,
    url_filter,
    warc,
    whitening,
)
from tidemark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def _exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def _secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def _simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_dedup(table(spark, sf_dir, "documents"))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def _lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scoring(table(spark, sf_dir, "documents"))


def _source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mix(table(spark, sf_dir, "documents")).drop("text", "n_chars")


def _centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.centroid_clustering(table(spark, sf_dir, "embeddings"))


def _whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening(table(spark, sf_dir, "embeddings"))


def _warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages")).drop("url")


def queries() -> dict[str, Query]:
    return {
        "op1_substring_dedup": _substring_dedup,
        "op2_exact_dedup": _exact_dedup,
        "op3_toxicity": _toxicity,
        "op4_decontamination": _decontamination,
        "op5_language_id": _language_id,
        "op6_secret_scan": _secret_scan,
        "op7_simhash_dedup": _simhash_dedup,
        "op8_url_filter": _url_filter,
        "op9_lm_scoring": _lm_scoring,
        "op10_source_mixing": _source_mixing,
        "op11_centroid_clustering": _centroid_clustering,
        "op12_whitening": _whitening,
        "op13_warc": _warc,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_dedup": oracles.EXACT_DEDUP,
        "op4_decontamination": oracles.DECONTAMINATION,
        "op8_url_filter": oracles.URL_FILTER,
        "op11_centroid_clustering": oracles.CENTROID_CLUSTERING,
        "op13_warc": oracles.WARC,
    }
