"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import cut, join_counted


def _marks(edges: DataFrame) -> tuple:
    """Changes if the set of edges does."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b), where root is the smallest node it reaches.

    Large-star and small-star in turn: every node's larger neighbours, then its
    smaller ones, are tied to the smallest node it knows, until nothing changes,
    after a number of rounds that grows with the logarithm of the longest path.
    Edges never outnumber those at the start. Hubs are split in the joins.
    """
    edges = cut(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before, after = None, _marks(edges)
    while before != after and after[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"), F.count("*").alias("n"))
        # Each edge is known by its smaller end, whose least node (itself, for a root) takes the larger end.
        ends = edges.select(F.col("b").alias("a"), F.col("a").alias("larger"))
        turned = join_counted(ends, cut(least), ["a"], "n", F.col("larger"))
        large = cut(turned.select(F.col("larger").alias("a"), F.col("least").alias("b")).where("a <> b").distinct())
        least = cut(large.groupBy("a").agg(F.min("b").alias("least"), F.count("*").alias("n")))
        small = join_counted(large, least, ["a"], "n", F.col("b")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = cut(least.select("a", F.col("least").alias("b")).unionByName(small).where("a <> b").distinct())
        before, after = after, _marks(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
