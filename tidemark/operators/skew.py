"""Joins that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# A key is heavy if it holds at least 1/HEAVY_ONE_IN of the rows, so there are
# at most HEAVY_ONE_IN heavy keys. The sketch tracks enough items (error about
# 3.5/SKETCH_ITEMS of the rows) not to miss one. SALTS is a power of two.
HEAVY_ONE_IN = 1024
SKETCH_ITEMS = 8192
SALTS = 256


def heavy_keys(df: DataFrame, key: str) -> Column:
    """Array of the heavy values of ``key``, as a scalar subquery.

    One pass over one column with a mergeable sketch and no shuffle of keys. It
    only steers the salting: a wrong guess costs speed, never a row.
    """
    sketch = f"approx_top_k(`{key}`, {HEAVY_ONE_IN}, {SKETCH_ITEMS})"
    return (
        df.where(F.col(key).isNotNull())
        .agg(F.expr(sketch).alias("top"), F.count("*").alias("n"))
        .select(
            F.expr(f"transform(filter(top, t -> t.count * {HEAVY_ONE_IN} >= n), t -> t.item)")
        )
        .scalar()
    )


def salted_join(
    many: DataFrame, one: DataFrame, key: str, spread: Sequence[str], heavy: Column, salts: int = SALTS
) -> DataFrame:
    """Inner join on ``key`` where ``one`` has at most one row per key.

    Rows of heavy keys are spread over ``salts`` sub-keys by a hash of
    ``spread``; the matching rows of ``one`` are repeated once per sub-key, at
    most ``HEAVY_ONE_IN * salts`` extra rows. All other keys use sub-key 0.
    """
    hot = F.array_contains(heavy, F.col(key))
    # Never NULL, so no IS NOT NULL on it is pushed below an aggregate, where it
    # would make the scan wait for the sketch.
    salt = F.when(hot, F.xxhash64(*spread).bitwiseAND(F.lit(salts - 1))).otherwise(F.lit(0))
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = many.where(F.col(key).isNotNull()).withColumn("_salt", salt.cast("int"))
    right = one.where(F.col(key).isNotNull()).withColumn("_salt", F.explode(copies))
    return left.join(right, [key, "_salt"]).drop("_salt")
