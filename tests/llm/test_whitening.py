import numpy as np
import pytest

from tidemark.llm.whitening import Whitening, _folded, bidiagonal, directions, dqds, whitening

SCHEMA = "vec_id long, embedding array<float>, component string, x long, n string, part int, payload string, whitened int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", 1, "n", 2, "p", 3) for i, v in rows], SCHEMA).repartition(5)


def _spectra():
    rng = np.random.default_rng(0)
    turn = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    yield "random", rng.normal(size=(200, 24))
    yield "graded", rng.normal(size=(200, 24)) * 10.0 ** -np.linspace(0, 8, 24)
    yield "rank", rng.normal(size=(200, 4)) @ rng.normal(size=(4, 24))
    yield "few", rng.normal(size=(3, 24))
    yield "repeated", np.diag(np.repeat([3.0, 2.0, 1e-3], 8)) @ turn
    yield "nearly", turn + 1e-9 * rng.normal(size=(24, 24))
    yield "identity", np.eye(24)
    yield "zero", np.zeros((24, 24))
    yield "constant", np.hstack([rng.normal(size=(50, 10)), np.zeros((50, 14))])
    yield "one", rng.normal(size=(50, 1))


@pytest.mark.parametrize("name,rows", list(_spectra()), ids=lambda v: v if isinstance(v, str) else "")
def test_values_and_directions(name, rows):
    r = np.linalg.qr(rows, mode="r")
    r = np.vstack([r, np.zeros((r.shape[1] - r.shape[0], r.shape[1]))])
    diagonal, above, v = bidiagonal(r)
    values, z = directions(diagonal, above)
    want = np.linalg.svd(r, compute_uv=False) ** 2
    top = want[0] or 1.0
    w = v @ z
    assert np.abs(values - want).max() <= 1e-13 * top
    assert np.abs(w.T @ w - np.eye(len(w))).max() < 1e-11
    assert np.abs(r.T @ (r @ w) - w * values).max() < 1e-11 * top


def test_small_values_of_a_bidiagonal_matrix_keep_their_digits():
    # Its values are the known ones of a product: B = diag(1, h, h^2, ...) has nothing above.
    diagonal = 10.0 ** -np.arange(12.0)
    assert np.allclose(dqds(diagonal, np.zeros(11)), diagonal**2, rtol=1e-14, atol=0)
    # One large entry above: the product of the values is the squared determinant, to full relative accuracy.
    found = dqds(diagonal, np.full(11, 1e-3))
    assert np.isclose(np.log(found).sum(), 2 * np.log(diagonal).sum(), rtol=1e-13, atol=0)


def _plain(rows, scale=64, offset=1_000_000):
    x = np.array([[int(np.floor(np.float64(np.float32(c)) * scale)) + offset for c in v] for _, v in rows])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(16, int((e > 1e-12 * e.sum()).sum()))
    w = (x - s / n) @ v[:, :k] / np.sqrt(e[:k])
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return n, deviation, w, e[:k] / e.sum()


@pytest.mark.parametrize("dims,count", [(20, 300), (3, 50), (20, 9)])
def test_equals_plain_version(spark, dims, count):
    rng = np.random.default_rng(dims)
    mix = rng.normal(size=(dims, dims))
    rows = [(i, (rng.normal(size=dims) @ mix).astype(np.float32).tolist()) for i in range(count)]
    rows += [(1000 + i, rows[i][1]) for i in range(5)]
    n, deviation, w, explained = _plain(rows)
    found = whitening(_frame(spark, rows)).toPandas().sort_values(["vec_id", "component"])
    k = w.shape[1]
    assert len(found) == len(rows) * k and set(found["n"]) == {n}
    assert found["vec_id"].tolist() == np.repeat([i for i, _ in rows], k).tolist()
    assert found["deviation"].tolist() == np.repeat(deviation, k).tolist()
    got = found["whitened"].to_numpy().reshape(-1, k)
    signs = np.sign((got * w).sum(0))
    assert np.abs(got - w * signs).max() < 1e-8
    assert np.allclose(found["explained"].to_numpy()[:k], explained, rtol=1e-8)
    assert 0 <= found["identity_error"].max() < 1e-9 and found["identity_error"].nunique() == 1


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.1, 2.0]), (2, [0.5, -1.0]), (2, [0.5, -1.0]), (None, [3.0, 1.0]), (3, [-2.0, 0.0])]
    bad = [(4, None), (5, []), (6, [nan, 1.0]), (7, [1.0, None]), (8, [inf, 0.0]), (9, [1.0]), (10, [1.0, 2.0, 3.0])]
    found = whitening(_frame(spark, good + bad)).collect()
    assert sorted(((r.vec_id, r.component) for r in found), key=repr) == sorted(((i, c) for i, _ in good for c in (1, 2)), key=repr)
    assert {r.n for r in found} == {4}
    # A single vector, or equal ones, have no direction.
    assert whitening(_frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whitening(_frame(spark, bad[:5])).collect() == []
    empty = whitening(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns[:2] == ["vec_id", "component"]


def test_large_entries(spark):
    rows = [(i, [3e38 if i % 2 else -3e38, float(i)]) for i in range(6)]
    found = whitening(_frame(spark, rows)).collect()
    # The second entry's share of the variance is that of rounding.
    assert len(found) == 6 and all(np.isfinite(r.whitened) for r in found) and {r.deviation for r in found} == {None}


def test_deviations_are_exact_or_null():
    model = Whitening(3, [10, 11], np.ones(0), np.ones(0), 0.0)
    assert model.deviations(np.array([[1, 2], [1 << 28, 5]])) == [49 + 25, (3 * (1 << 28) - 10) ** 2 + 16]
    assert model.deviations(np.array([[1, 2], [1 << 40, 5]])) == [49 + 25, None]


@pytest.mark.parametrize("count", [0, 1, 7, 40])
def test_folding_in_a_tree_keeps_every_part(spark, count):
    parts = spark.createDataFrame([(3 * i, bytes([i])) for i in range(count)], "part long, payload binary")
    found = _folded(parts, lambda ps: bytes(sorted(b"".join(ps))), fan=3)
    assert (found or b"") == bytes(range(count))
