"""Exact deduplication by skew-safe combining of digest groups.

Three steps, each of which compares whole texts, not only digests: every task
folds its own equal texts (the map side of the first aggregation); what tasks
hold of one digest meets in salted groups, so the copies of a hot text are
spread over ``SALTS`` reducers; the winners of the salts are combined to one
winner per text. Documents then find their winner by digest alone, in a join
that splits hot digests. Different texts with one digest are noticed and told
apart by their texts.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import cut, join_counted, keep_rows, lower_ascii, map_batches

SALTS = 64


def _keyed(docs: DataFrame, id_col: str, text_col: str, digest_bytes: int) -> DataFrame:
    def key(batch):
        norm = [lower_ascii(t) for t in batch.column(1).to_pylist()]
        sha = [hashlib.sha256(t).digest() for t in norm]
        yield {"doc_id": batch.column(0), "digest": [s[:digest_bytes] for s in sha], "sha": sha, "norm": norm}

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return map_batches(slim, key, "doc_id long, digest binary, sha binary, norm binary")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest_bytes: int = 32
) -> DataFrame:
    """Each document with the one of its equals that stays.

    Texts are equal when identical after lowering A-Z; null counts as empty.
    The row with the largest id stays; null ids are smaller than all others.
    Rows that repeat both id and text are one document: one row in the result,
    though ``group_size`` counts each. An empty table gives an empty result,
    other columns are ignored. ``digest_bytes`` under 32 groups by a prefix of
    the digest, for trials of what happens when digests collide.

    Returns doc_id, keep_id, group_size, kept, text_sha256.
    """
    keyed = _keyed(docs, id_col, text_col, digest_bytes)
    salted = (
        keyed.withColumn("salt", F.spark_partition_id() % salts)
        .groupBy("digest", "salt", "norm")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
    )
    winners = salted.groupBy("digest", "norm").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    classes = cut(
        winners.groupBy("digest").agg(
            F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"), F.count("*").alias("texts")
        )
    )
    rows = keyed.select("doc_id", "digest", "sha")
    found = join_counted(
        rows, classes.where("texts = 1").drop("texts"), ["digest"], "group_size", F.col("doc_id"), distinct=True
    )
    collided = classes.where("texts > 1").select("digest")
    if not collided.isEmpty():
        by_text = winners.join(collided, "digest", "left_semi").withColumnRenamed("n", "group_size")
        met = join_counted(keyed, by_text, ["digest", "norm"], "group_size", F.col("doc_id"), distinct=True)
        found = found.unionByName(met.select(*found.columns))
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, one row for each different text."""
    kept = exact_dedup(docs, id_col, text_col).where("kept")
    return keep_rows(docs, kept.select("doc_id", F.unhex("text_sha256").alias("digest")), id_col, text_col)
