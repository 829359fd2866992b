"""Latest row per key and key profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def latest_per_key(
    df: DataFrame, ids: Sequence[str], ts: str | Sequence[str], tie: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the one with the greatest ``ts``, NULL ``ts`` last.

    ``max_by`` is an ordinary aggregate with a map-side part, so of a hot key
    each task ships one candidate row, never the whole group. ``tie`` columns
    decide equal timestamps; without them an arbitrary row wins.
    """
    order = [ts] if isinstance(ts, str) else list(ts)
    rest = [c for c in df.columns if c not in ids]
    # A struct is never NULL, and NULL fields sort first: NULL timestamps lose.
    rank = F.struct(*[F.col(c) for c in (*order, *tie)])
    best = df.groupBy(*ids).agg(F.max_by(F.struct(*rest), rank).alias("_best"))
    return best.select(
        *[F.col(c) if c in ids else F.col("_best")[c].alias(c) for c in df.columns]
    )


def split_null_keys(df: DataFrame, ids: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is complete, rows with a NULL in the key)."""
    complete = F.lit(True)
    for name in ids:
        complete = complete & F.col(name).isNotNull()
    return df.where(complete), df.where(~complete)


def profile_key(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One row: all rows, rows with a complete key, distinct complete keys.

    Counting per key first keeps the distinct count a plain two-level sum.
    """
    complete = F.lit(True)
    for name in ids:
        complete = complete & F.col(name).isNotNull()
    per_key = df.groupBy(*ids).agg(F.count("*").alias("_n")).withColumn("_ok", complete)
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("_ok"), F.col("_n"))), F.lit(0)).alias("n_keyed"),
        F.count(F.when(F.col("_ok"), 1)).alias("n_keys"),
    )
