"""Whitening of embeddings by a singular value decomposition of the centred rows.

Blocks of centred rows are reduced to triangular factors by QR, and those to one
factor R in a tree of stacked QRs. R is brought to bidiagonal form by
Householder reflections from both sides. The dqds iteration finds the squared
singular values with high relative accuracy: a transform without shift gives the
diagonal of the inverse, whose trace is a shift that never overshoots, and
shifted transforms follow until the last value splits off. For each value, the
stationary and the progressive qd transform of the bidiagonal matrix meet where
their twist is smallest, and the twisted factorisation gives the vector there;
vectors of values close together are made orthogonal. Carried back by the
reflections they are the directions of the covariance, whose values are the
squares over the number of rows.

Rows are integers, so sums, and with them the centre, are exact, and rows are
centred before anything is multiplied. The driver holds one triangular factor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.centroid_clustering import usable
from tidemark.llm.common import cut, map_batches

COMPONENTS = 16
SCALE = 64
OFFSET = 1_000_000
LARGEST = 1 << 40
# Factors that meet in one task of the tree.
FAN = 32
# Directions with less than this share of the variance are noise of rounding.
LEAST_SHARE = 1e-12
_EPS = np.finfo(np.float64).eps
_LONG = (1 << 63) - 1


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with ``r = U B V'`` for a square ``r``: reflections from the left and the right in turn."""
    b, n = r.astype(np.float64).copy(), len(r)
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        """u of length sqrt(2) with (I - u u') x along the first axis."""
        size = np.sqrt((x * x).sum())
        if size == 0:
            return None
        u = x / size
        u[0] += 1.0 if u[0] >= 0 else -1.0
        return u / sqrt(abs(u[0]))

    for k in range(n):
        if (u := reflector(b[k:, k])) is not None:
            b[k:, k:] -= np.outer(u, u @ b[k:, k:])
        if k + 2 < n and (u := reflector(b[k, k + 1 :])) is not None:
            b[k:, k + 1 :] -= np.outer(b[k:, k + 1 :] @ u, u)
            v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(b).copy(), np.diag(b, 1).copy(), v


def _transform(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One dqds transform: the new (q, e) and the d's, some of which are negative if the shift was too large."""
    n = len(q)
    new_q, new_e, ds = np.empty(n), np.empty(n - 1), np.empty(n)
    d = q[0] - shift
    for i in range(n - 1):
        ds[i] = d
        new_q[i] = d + e[i]
        ratio = q[i + 1] / new_q[i]
        new_e[i] = e[i] * ratio
        d = d * ratio - shift
    ds[-1] = new_q[-1] = d
    return new_q, new_e, ds


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The squared singular values of an upper bidiagonal matrix, falling."""
    q, e = diagonal.astype(np.float64) ** 2, above.astype(np.float64) ** 2
    if not len(q) or not (top := max(q.max(), e.max(initial=0.0))):
        return np.zeros(len(q))
    tiny = top * 1e-250
    found: list[float] = []
    todo = [(np.maximum(q, tiny), e, 0.0)]
    while todo:
        q, e, sigma = todo.pop()
        while len(q):
            n = len(q)
            small = np.flatnonzero(e <= _EPS * _EPS * (sigma + q[1:]) + tiny * _EPS)
            if n == 1 or (len(small) and small[-1] == n - 2):
                found.append(sigma + q[-1])
                q, e = q[:-1], e[: max(n - 2, 0)]
                continue
            if len(small):
                at = small[-1] + 1
                todo.append((q[:at], e[: at - 1], sigma))
                q, e = q[at:], e[at:]
                continue
            # Without a shift, the reciprocals of the d's are the diagonal of the inverse.
            q, e, ds = _transform(q, e, 0.0)
            q = np.maximum(q, tiny)
            shift = (1 - 64 * n * _EPS) / (1 / np.maximum(ds, tiny)).sum()
            shifted = _transform(q, e, shift)
            if shift > _EPS * sigma and shifted[2].min() > 0:
                (q, e, _), sigma = shifted, sigma + shift
    return np.sort(np.maximum(np.array(found), 0.0))[::-1]


def _twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """The unit vector z of B'B z = value z, from the stationary and the progressive qd transform of B."""
    n, q = len(diagonal), diagonal**2
    if n == 1:
        return np.ones(1)
    tiny = (q.max() + (above**2).max()) * 1e-40 + np.finfo(float).tiny
    safe = lambda x: x if abs(x) > tiny else (tiny if x >= 0 else -tiny)
    s, down = np.empty(n), np.empty(n - 1)
    s[0] = -value
    for i in range(n - 1):
        down[i] = diagonal[i] * above[i] / safe(q[i] + s[i])
        s[i + 1] = down[i] * (above[i] / safe(diagonal[i])) * s[i] - value
    p, up = np.empty(n), np.empty(n - 1)
    p[-1] = q[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = safe(above[i] ** 2 + p[i + 1])
        up[i] = diagonal[i] * above[i] / pivot
        p[i] = p[i + 1] * (q[i] / pivot) - value
    twist = int(np.abs(s + p + value).argmin())
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.sqrt((z * z).sum())


def _orthogonal(z: np.ndarray, others: list[np.ndarray], retry: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``z`` without its parts along ``others``; where next to nothing is left, of ``retry`` applied to other starts."""

    def rest(x: np.ndarray) -> np.ndarray:
        for _ in range(3):
            for o in others:
                x = x - o * (o @ x)
        return x

    for attempt in range(8):
        left = sqrt((found := rest(z)) @ found)
        # What is left of a vector of the common subspace is one of it too, up to rounding over its size.
        if left > 1e-4:
            break
        start = rest(np.cos(np.arange(1, len(z) + 1) * (attempt + 1.7)))
        z = retry(start / sqrt(start @ start))
        z = z / sqrt(z @ z)
    return rest(found / left)


def directions(diagonal: np.ndarray, above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values, falling; right singular vectors as columns) of an upper bidiagonal matrix."""
    n = len(diagonal)
    top = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    # What the reflections have rounded anyhow ties no blocks together.
    cuts = [0, *(np.flatnonzero(np.abs(above) <= 8 * _EPS * top) + 1).tolist(), n]
    values, vectors = [], []
    for a, b in zip(cuts, cuts[1:]):
        # Blocks that no entry ties together have values and vectors of their own.
        d, e = diagonal[a:b], above[a : b - 1]
        d = np.where(np.abs(d) > top * 1e-25, d, top * 1e-25) if top else d
        gram = np.diag(d * d) + np.diag(d[:-1] * e, 1) + np.diag(d[:-1] * e, -1)
        gram[np.arange(1, b - a), np.arange(1, b - a)] += e * e
        own: list[tuple[float, np.ndarray]] = []
        for value in dqds(d, e):
            near = [z for v, z in own if v - value <= 1e-3 * v or value <= 1e-13 * top * top]

            def again(start: np.ndarray, value: float = value, gram: np.ndarray = gram) -> np.ndarray:
                move = value * (1 + 4 * _EPS) + top * top * 1e-18
                return np.linalg.solve(gram - move * np.eye(len(gram)), start)

            z = _twisted(d, e, value) if top else np.eye(b - a)[len(own)]
            own.append((value, _orthogonal(z, near, again) if near else z))
        for value, z in own:
            whole = np.zeros(n)
            whole[a:b] = z
            values.append(value)
            vectors.append(whole)
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors).reshape(n, n)[order].T


@dataclass(frozen=True)
class Whitening:
    """The centre as exact sums over ``n`` rows, and the directions (columns) with their variances, falling."""

    n: int
    sums: list[int]
    variances: np.ndarray
    vectors: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n`` for rows of int64, with one rounding."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        part = np.array([s % self.n for s in self.sums], dtype=np.float64) / self.n
        return (x - whole).astype(np.float64) - part

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n x - sums)^2 over the dimensions, exact; None where a long does not hold it."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        part = np.array([s % self.n for s in self.sums], dtype=np.int64)
        off = x - whole
        most = self.n * (int(np.abs(off).max(initial=0)) + 1)
        if most * most * x.shape[1] <= _LONG:
            return ((off * self.n - part) ** 2).sum(1).tolist()
        exact = [sum((int(o) * self.n - int(p)) ** 2 for o, p in zip(row, part)) for row in off]
        return [d if d <= _LONG else None for d in exact]


def integer_rows(df: DataFrame, id_col: str, vector_col: str, scale: int, offset: int) -> DataFrame:
    """(vec_id, x): the vectors of the most common size without null or non-finite entries, as integers."""
    whole = F.transform(
        "v",
        lambda c: F.greatest(
            F.least(F.floor(F.greatest(F.least(c, F.lit(1e15)), F.lit(-1e15)) * scale) + offset, F.lit(LARGEST)), F.lit(-LARGEST)
        ).cast("long"),
    )
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        usable(F.col("v")) & (F.size("v") > 0)
    )
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.where(F.size("v") == (sizes[0]["size"] if sizes else 0)).select("vec_id", whole.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.int64) if len(column) else np.zeros((0, 0), dtype=np.int64)


def _folded(parts: DataFrame, merge: Callable[[list[bytes]], bytes], fan: int = FAN) -> bytes | None:
    """One payload out of (part, payload), merged ``fan`` at a time until so few are left that the driver merges them."""
    parts = cut(parts)
    count = parts.count()
    while count > fan:
        groups = -(-count // fan)

        def some(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("part")
            return pd.DataFrame({"part": [int(pdf["group"].iloc[0])], "payload": [merge(list(pdf["payload"]))]})

        dealt = parts.withColumn("group", F.pmod("part", F.lit(groups)))
        parts = cut(dealt.groupBy("group").applyInPandas(some, "part long, payload binary"))
        count = parts.count()
    left = [r.payload for r in parts.orderBy("part", "payload").collect()]
    return merge(left) if left else None


def _numbered(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], bytes | None]) -> DataFrame:
    """(part, payload): what ``function`` makes of each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (payload := function(batches)) is not None:
            yield pa.RecordBatch.from_pydict({"payload": pa.array([payload], pa.binary())})

    return df.mapInArrow(run, "payload binary").select(F.spark_partition_id().cast("long").alias("part"), "payload")


def triangular(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The triangular factor of all rows (x) less their centre."""
    size, centre = len(sums), Whitening(n, sums, np.ones(0), np.ones(0), 0.0)

    def block(batches: Iterator[pa.RecordBatch]) -> bytes | None:
        r = None
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                rows = centre.centred(_matrix(batch.column(0).slice(start, 4096)))
                r = np.linalg.qr(rows if r is None else np.vstack([r, rows]), mode="r")
        return None if r is None else np.vstack([r, np.zeros((size - len(r), size))]).astype("<f8").tobytes()

    def merge(payloads: list[bytes]) -> bytes:
        stacked = np.vstack([np.frombuffer(p, "<f8").reshape(size, size) for p in payloads])
        return np.linalg.qr(stacked, mode="r").astype("<f8").tobytes()

    merged = _folded(_numbered(fit, block), merge)
    return np.frombuffer(merged, "<f8").reshape(size, size) if merged else np.zeros((size, size))


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of distinct integer rows (x); None if there are none."""
    size = fit.select(F.size("x").alias("size")).limit(1).collect()
    if not size:
        return None
    # Apart by their value, sums of longs up to 2**40 could pass 2**63: as decimals they cannot.
    sums = fit.agg(F.count("*").alias("n"), *[F.sum(F.col("x")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(size[0][0])]).first()
    n, exact = sums.n, [int(sums[f"s{i}"]) for i in range(size[0][0])]
    diagonal, above, v = bidiagonal(triangular(fit, n, exact))
    values, z = directions(diagonal, above)
    total = float(values.sum()) / n
    kept = [i for i in range(min(components, len(values))) if values[i] > LEAST_SHARE * values.sum()]
    vectors = (v @ z)[:, kept]
    # Either sign would do: the largest entry is positive.
    largest = np.abs(vectors).argmax(0)
    vectors = vectors * np.where(vectors[largest, np.arange(len(kept))] < 0, -1.0, 1.0)
    return Whitening(n, exact, values[kept] / n, vectors, total)


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest entry of the covariance of the whitened rows less the identity."""
    k = len(model.variances)
    if not k:
        return 0.0

    def moments(batches: Iterator[pa.RecordBatch]) -> bytes | None:
        total = np.zeros(k * k + k + 1)
        for batch in batches:
            if batch.num_rows:
                total = _joined(total, _moments(model.whiten(_matrix(batch.column(0)))))
        return total.astype("<f8").tobytes() if total[0] else None

    def _moments(w: np.ndarray) -> np.ndarray:
        mean = w.mean(0)
        return np.concatenate([[len(w)], mean, ((w - mean).T @ (w - mean)).ravel()])

    def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Counts, means and centred products of two sets of rows taken together."""
        if not a[0]:
            return b
        n, gap = a[0] + b[0], b[1 : k + 1] - a[1 : k + 1]
        mean = a[1 : k + 1] + gap * (b[0] / n)
        return np.concatenate([[n], mean, a[k + 1 :] + b[k + 1 :] + np.outer(gap, gap).ravel() * (a[0] * b[0] / n)])

    def merge(payloads: list[bytes]) -> bytes:
        total = np.zeros(k * k + k + 1)
        for p in payloads:
            total = _joined(total, np.frombuffer(p, "<f8"))
        return total.astype("<f8").tobytes()

    merged = np.frombuffer(_folded(_numbered(fit, moments), merge), "<f8")
    return float(np.abs(merged[k + 1 :].reshape(k, k) / merged[0] - np.eye(k)).max())


def whitening(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """Each vector along the leading directions of all, with unit variance along each.

    Vectors that are null, empty, or hold a null or non-finite entry give no
    rows; of vectors of several sizes the most common size stays (the larger of
    equals). Entries become ``floor(scale * entry) + offset``, clamped to
    +-2**40. The centre and the directions are those of the distinct vectors;
    repeated rows give rows of their own. Directions with under 1e-12 of the
    variance, as in tables with fewer vectors than dimensions, give no rows. An empty table
    gives an empty result; other columns are ignored. A deviation that does not
    fit a long is null.

    Returns vec_id, component, n, deviation, whitened, explained, identity_error.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = integer_rows(df, id_col, vector_col, scale, offset)
    fit = cut(rows.select("x").distinct())
    model = fit_whitening(fit, components)
    if model is None or not len(model.variances):
        return df.sparkSession.createDataFrame([], schema)
    error, k = identity_error(fit, model), len(model.variances)

    def project(batch: pa.RecordBatch):
        x = _matrix(batch.column(1))
        if not len(x):
            return
        every = pa.array(np.repeat(np.arange(len(x)), k))
        yield {
            "vec_id": batch.column(0).take(every),
            "component": pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
            "n": np.full(len(x) * k, model.n),
            "deviation": pa.array(model.deviations(x), pa.int64()).take(every),
            "whitened": model.whiten(x).ravel(),
            "explained": np.tile(model.variances / model.total, len(x)),
            "identity_error": np.full(len(x) * k, error),
        }

    return map_batches(rows, project, schema)
