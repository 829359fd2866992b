import hashlib

import numpy as np
import pytest

from tidemark.llm.centroid_clustering import LARGEST, Move, assign, centroid_clustering, integer_vectors, kmeans, loosening, squared_distances

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance long, x int, upper string, n long, radius int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", 1, 2, "u", 3, 4) for i, v in rows], SCHEMA).repartition(3)


def _plain(rows, k, rounds, dims, scale=256):
    """Lloyd's rounds in exact integers, as the contract states them."""
    kept = [
        (i, [min(max(int(np.floor(np.float64(np.float32(c)) * scale)), -LARGEST), LARGEST) for c in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(c is not None and np.isfinite(c) for c in v)
    ]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    c = [x for _, x in start[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, y)), j) for j, y in enumerate(c))
    for _ in range(rounds):
        own = [near(x)[1] for _, x in kept]
        c = [
            [sum(col) // len(col) for col in zip(*members)] if (members := [x for (_, x), o in zip(kept, own) if o == j]) else y
            for j, y in enumerate(c)
        ]
    found = [(i, *near(x)) for i, x in kept]
    inertia = [sum(d for _, d, o in found if o == j) for j in range(len(c))]
    return sorted(
        [(i, j, d, inertia[j], sum(inertia), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, d, j in found], key=repr
    )


def _found(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.mark.parametrize("k,spread", [(7, 1.0), (20, 0.05)])
def test_equals_brute_force(spark, k, spread):
    rng = np.random.default_rng(3)
    places = rng.normal(size=(6, 5))
    rows = [(i, (places[i % 6] + spread * rng.normal(size=5)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(i, rows[i][1]) for i in range(30)] + [(900 + i, [0.5] * 5) for i in range(40)]
    df = _frame(spark, rows)
    assert _found(centroid_clustering(df, k=k, rounds=4, dimensions=5)) == _plain(rows, k, 4, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.0, 1.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (2, [3.0, 1.0]), (None, [3.0, -1.0]), (3, None), (4, []), (5, [1.0]),
        (6, [1.0, 2.0, 3.0]), (7, [None, 1.0]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [-inf, 0.0]), (11, [-0.001, 0.001]),
        (12, [3e38, -3e38]), (13, [1.0, 1.0]),
    ]
    for k in (1, 3, 40):
        found = centroid_clustering(_frame(spark, rows), k=k, rounds=3, dimensions=2)
        assert _found(found) == _plain(rows, k, 3, 2)
    assert centroid_clustering(_frame(spark, rows[5:12]), dimensions=2).collect() == []
    empty = centroid_clustering(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_loosening_bounds_every_point_of_the_sphere_and_is_below_the_drift():
    rng = np.random.default_rng(1)
    old = rng.normal(size=(6, 8)) * 10
    new = old + rng.normal(size=(6, 8)) * np.array([[0.0], [0.1], [1], [3], [8], [2]])
    radius = rng.uniform(0.5, 9, size=6)
    bound = loosening(old, new, radius)
    drift = np.sqrt(((new - old) ** 2).sum(1))
    assert (bound <= drift[None, :] + 1e-12).all() and bound.sum() < 0.7 * drift.sum() * 5
    for i in range(6):
        points = rng.normal(size=(20_000, 8))
        points = old[i] + radius[i] * points / np.sqrt((points**2).sum(1))[:, None] * rng.uniform(0, 1, (20_000, 1)) ** 0.125
        for j in set(range(6)) - {i}:
            nearer = np.sqrt(((points - old[j]) ** 2).sum(1)) - np.sqrt(((points - new[j]) ** 2).sum(1))
            assert nearer.max() <= bound[i, j] + 1e-9


def test_bounds_spare_scans_and_never_change_an_assignment():
    rng = np.random.default_rng(2)
    places = rng.integers(-300, 300, size=(12, 16))
    x = places[rng.integers(12, size=3000)] + rng.integers(-40, 40, size=(3000, 16))
    state = (np.full(len(x), -1), np.full(len(x), np.inf), np.full(len(x), np.inf))
    move, shares = Move.start(x[:12].copy()), []
    for _ in range(8):
        cluster, upper, lower, scanned = assign(x, *state, move)
        assert np.array_equal(cluster, squared_distances(x, move.centroids).argmin(1))
        exact = np.sqrt(squared_distances(x, move.centroids).astype(float))
        assert (upper >= exact.min(1) - 1e-9).all() and (lower <= np.partition(exact, 1, axis=1)[:, 1] + 1e-9).all()
        shares.append(scanned.mean())
        state = (cluster, upper, lower)
        new, radius = move.centroids.copy(), np.zeros(12)
        for j in set(cluster.tolist()):
            new[j], radius[j] = x[cluster == j].sum(0) // (cluster == j).sum(), upper[cluster == j].max() + 1e-6
        move = Move.between(move.centroids, new, radius)
    assert shares[0] == 1 and shares[-1] < 0.05 and sum(shares[1:]) < 4


def test_large_entries_are_exact():
    x = np.array([[LARGEST, -LARGEST], [LARGEST - 1, 7]])
    assert squared_distances(x, x).tolist() == [[0, 1 + (LARGEST + 7) ** 2], [1 + (LARGEST + 7) ** 2, 0]]


def test_state_holds_each_vector_once(spark):
    rows = [(i, [float(i % 9), float(i % 4)]) for i in range(200)]
    state, centroids = kmeans(integer_vectors(_frame(spark, rows), "vec_id", "embedding", 2, 1), 5, 3, 2)
    assert sorted(r.vec_id for r in state.collect()) == list(range(200)) and centroids.shape == (5, 2)
