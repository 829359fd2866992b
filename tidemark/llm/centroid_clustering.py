"""k-means over integer vectors, with bounds loosened by the geometry of the drift.

Every vector keeps an upper bound of the distance to its own centroid and a
lower bound of the distance to all others. After the centroids moved, the upper
bound grows by its own centroid's drift. The lower bound is loosened for the
cluster as a whole: its vectors lie in a sphere around the old centroid, and in
the plane through that centre and the old and new place of another centroid, no
point of the sphere comes nearer to that one by more than ``drift * cos(a - b)``
(a: angle between the drift and the sphere's centre, seen from the middle of the
drift; b: half the angle under which the sphere is seen). That is mostly far
less than the drift, and nothing for centroids that move away. Vectors whose
bounds still tell their cluster are left alone; for the others the own distance
is taken exactly, and if that does not settle it, all centroids are scanned.

All decisions are those of exact arithmetic: distances are integers, and bounds
decide only with a margin far above rounding. One round is a pass over the
table of vectors with their bounds, written below ``spark.checkpoint.dir``, and
a native aggregation of integer sums with a map-side part. The driver holds the
``k`` centroids only.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import cut, map_batches
from tidemark.sinks.storage import remove, shared_dir

K = 40
ROUNDS = 5
DIMENSIONS = 64
SCALE = 256
SEED = "2:"
# Components are clamped here, so that squared distances fit a long.
LARGEST = 1 << 27
_EXACT_IN_DOUBLES = 1 << 21
_MARGIN = 1e-7
_LONG = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite entry."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, dimensions: int, scale: int) -> DataFrame:
    """(vec_id, x): vectors of the right size without null or non-finite entries, as integers."""
    vector = F.col(vector_col).cast("array<double>")
    whole = F.transform(
        "v", lambda c: F.greatest(F.least(F.floor(F.greatest(F.least(c, F.lit(1e15)), F.lit(-1e15)) * scale), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int")
    )
    return (
        df.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v"))
        .where((F.size("v") == dimensions) & usable(F.col("v")))
        .select("vec_id", whole.alias("x"))
    )


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` (int64) to each centroid, as integers."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) < _EXACT_IN_DOUBLES:
        # Every partial sum is an integer below 2**53.
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], axis=1)


@dataclass(frozen=True)
class Move:
    """Where the centroids are now, and what their last move does to the bounds of each cluster's vectors."""

    centroids: np.ndarray
    drift: np.ndarray
    loosen: np.ndarray
    half_gap: np.ndarray

    @staticmethod
    def start(centroids: np.ndarray) -> Move:
        none = np.zeros(len(centroids))
        return Move(centroids, none, none, none)

    @staticmethod
    def between(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> Move:
        gaps = np.sqrt(squared_distances(new, new).astype(np.float64))
        np.fill_diagonal(gaps, np.inf)
        drift = np.sqrt(((new - old) ** 2).sum(1).astype(np.float64))
        return Move(new, drift, loosening(old, new, radius).max(1), gaps.min(1, initial=np.inf) / 2)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """By how much centroid j can have come nearer to a vector of cluster i, at most, as entry (i, j); 0 for i = j.

    With m the middle of the drift of j and v = x - m, the difference of the
    distances of x to the old and the new place is at most drift * cos(v, drift):
    their sum is at least 2 |v|. The largest cosine over the sphere around the
    old centroid i is that of the angle to its centre less the angle it fills.
    """
    a, b = old.astype(np.float64), new.astype(np.float64)
    move = b - a
    drift = np.sqrt((move * move).sum(1))
    centre = a[:, None, :] - ((a + b) / 2)[None, :, :]
    away = np.sqrt((centre * centre).sum(2))
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.clip((centre * move[None, :, :]).sum(2) / (away * drift[None, :]), -1, 1)
        filled = np.clip(radius[:, None] / away, 0, 1)
    angle = np.arccos(cosine) - np.arcsin(filled)
    inside = ~(radius[:, None] < away) | ~np.isfinite(angle)
    most = drift[None, :] * np.where(inside | (angle <= 0), 1.0, np.maximum(np.cos(angle), 0.0))
    most[:, drift == 0] = 0.0
    np.fill_diagonal(most, 0.0)
    return most


def assign(
    x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, move: Move
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, upper, lower, scanned): the exactly nearest centroids; cluster -1 stands for none yet."""
    c = move.centroids
    known = cluster >= 0
    own = np.where(known, cluster, 0)
    upper = np.where(known, upper + move.drift[own], np.inf)
    lower = np.where(known, np.maximum(lower - move.loosen[own], move.half_gap[own]), -np.inf)
    cluster = own.astype(np.int64)

    def unsure(rows: np.ndarray) -> np.ndarray:
        # Written so that infinite bounds, as of a single centroid, compare right.
        return rows[~(upper[rows] * (1 + _MARGIN) + _MARGIN < lower[rows])]

    near = unsure(np.arange(len(x)))
    near = np.union1d(near, np.flatnonzero(~known))
    upper[near] = np.sqrt(((x[near] - c[cluster[near]]) ** 2).sum(1).astype(np.float64))
    scan = np.union1d(unsure(near), np.flatnonzero(~known))
    if len(scan):
        d = squared_distances(x[scan], c)
        best = d.argmin(1)  # the smaller number of equals
        cluster[scan] = best
        upper[scan] = np.sqrt(d[np.arange(len(scan)), best].astype(np.float64))
        others = d.astype(np.float64)
        others[np.arange(len(scan)), best] = np.inf
        lower[scan] = np.sqrt(others.min(1))
    scanned = np.zeros(len(x), dtype=bool)
    scanned[scan] = True
    return cluster, upper, lower, scanned


_STATE = "vec_id long, x array<int>, cluster int, upper double, lower double, scanned boolean"


def _assigned(state: DataFrame, move: Move, dimensions: int) -> DataFrame:
    def run(batch):
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)
        cluster, upper, lower = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
        cluster, upper, lower, scanned = assign(x, cluster, upper, lower, move)
        yield {
            "vec_id": batch.column(0),
            "x": batch.column(1),
            "cluster": pa.array(cluster, pa.int32()),
            "upper": upper,
            "lower": lower,
            "scanned": scanned,
        }

    return map_batches(state, run, _STATE)


def _moved(state: DataFrame, move: Move, dimensions: int) -> Move:
    """The centroids after every non-empty one went to the floor of its vectors' mean."""
    sums = [F.sum(F.col("x")[i].cast("long")).alias(f"s{i}") for i in range(dimensions)]
    found = state.groupBy("cluster").agg(F.count("*").alias("n"), F.max("upper").alias("radius"), *sums).collect()
    new, radius = move.centroids.copy(), np.zeros(len(move.centroids))
    for r in found:
        new[r.cluster] = [r[f"s{i}"] // r.n for i in range(dimensions)]
        # Above the rounding of the bounds themselves.
        radius[r.cluster] = r.radius * (1 + _MARGIN) + _MARGIN
    return Move.between(move.centroids, new, radius)


def kmeans(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: str = SEED
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, x, cluster, upper, lower, scanned) of the last assignment, the centroids) of integer vectors (vec_id, x).

    The start is the ``k`` vectors whose SHA-256 of ``seed`` and id is smallest,
    those without an id last. Each of ``rounds`` assigns all vectors and moves
    the centroids; then all are assigned once more.
    """
    spark = vectors.sparkSession
    digest = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(digest.asc_nulls_last(), "x").limit(k).collect()
    move = Move.start(np.array([r.x for r in first], dtype=np.int64).reshape(-1, dimensions))
    infinite = F.lit(float("inf"))
    state = vectors.select(
        "vec_id", "x", F.lit(-1).alias("cluster"), infinite.alias("upper"), infinite.alias("lower"), F.lit(False).alias("scanned")
    )
    if not first:
        return state, move.centroids
    base, before = shared_dir(spark, "centroids"), None
    for done in range(rounds):
        path = f"{base}/round-{done}"
        _assigned(state, move, dimensions).write.parquet(path)
        if before:
            remove(spark, before)
        state, before = spark.read.parquet(path), path
        move = _moved(state, move, dimensions)
    state = cut(_assigned(state, move, dimensions))
    remove(spark, base)
    return state, move.centroids


def centroid_clustering(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: str = SEED,
) -> DataFrame:
    """The cluster of each vector, its squared distance, and the inertia and centroid of the cluster.

    Vectors that are null, of another size, or hold a null or non-finite entry
    give no row. Entries become ``floor(scale * entry)``, clamped to +-2**27.
    Rows may repeat ids and vectors: each is a vector of its own. Of centroids
    at one distance the smaller number wins; empty clusters keep their centroid.
    With fewer than ``k`` vectors each is a centroid. An empty table gives an
    empty result; other columns are ignored. An inertia that does not fit a
    long is null.

    Returns vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.
    """
    state, centroids = kmeans(integer_vectors(df, id_col, vector_col, dimensions, scale), k, rounds, dimensions, seed)
    spark = df.sparkSession
    if not len(centroids):
        return state.select(
            "vec_id",
            "cluster",
            *[F.lit(None).cast(t).alias(n) for n, t in (("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))],
        ).limit(0)

    def measured(batch):
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)
        cluster = batch.column(2).to_numpy(zero_copy_only=False)
        yield {"vec_id": batch.column(0), "cluster": batch.column(2), "distance": ((x - centroids[cluster]) ** 2).sum(1)}

    rows = map_batches(state.select("vec_id", "x", "cluster"), measured, "vec_id long, cluster int, distance long")
    sums = {r.cluster: int(r.s) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda n: n if n <= _LONG else None
    about = [
        (i, fits(sums.get(i, 0)), fits(sum(sums.values())), hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest())
        for i, c in enumerate(centroids)
    ]
    table = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
