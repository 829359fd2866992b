"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are positives; everything else is text without a
label, some of it toxic too. A linear classifier over the words of a text
minimises the class-prior-corrected risk

    prior * mean_P loss(f) + max(0, mean_U loss(-f) - prior * mean_P loss(-f)),

where the second part estimates the risk on negatives, which unlabelled text
does not show directly; where it falls below zero, a step undoes it instead of
fitting it further. Several numpy classifiers are trained, each in a task of its
own on its own draw of unlabelled texts, and their weights averaged. The prior
is the rate of toxic among the labelled rows that may be learned from.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import map_batches
from tidemark.llm.language_id import words

BUCKETS = 1 << 20
# Bounds, in expectation, of what the classifiers are fitted on (drawn by hash of the id).
POSITIVES = 2000
UNLABELLED = 4000
MEMBERS = 4
# L1 penalty, in parts of the prior, and steps of the training.
SHRINK, STEPS = 0.027, 400
# Words left out are checked again so many times at most, as long as one belongs in.
ROUNDS = 5
INTERCEPT = -1
_FOLDS = 5


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % _FOLDS == 0


def bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


def features(text: str | None) -> list[int]:
    """The buckets of the distinct words of a text."""
    return sorted({bucket(w) for w in set(words(text))})


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, shrink: float = SHRINK, steps: int = STEPS
) -> tuple[np.ndarray, np.ndarray, float]:
    """(buckets, weights, intercept) of a logistic classifier: accelerated proximal steps on the non-negative risk.

    The L1 penalty is ``shrink`` times the prior: a word's slope at the start is
    the prior times the difference of its document rates, so the difference is
    held against ``shrink``, or the largest standard error of the positives'
    rates if that is more, whatever the prior. Words below that are left out;
    at the optimum their slopes are checked again, and those above the penalty
    let in.
    """
    # A rate is known no better than its standard error.
    shrink = max(shrink, 0.5 / np.sqrt(len(positive)))
    penalty = shrink * prior
    rate = lambda rows: np.bincount(np.concatenate(rows).astype(np.int64), minlength=BUCKETS) / len(rows)
    active = np.flatnonzero(np.abs(rate(unlabelled) - rate(positive)) >= shrink)
    for _ in range(ROUNDS):
        weights, of_p, of_u = _fitted(active, positive, unlabelled, prior, penalty, steps)
        # The slope of every word, active or not.
        sums = lambda rows, each: np.bincount(
            np.concatenate(rows).astype(np.int64), np.repeat(each, [len(r) for r in rows]), BUCKETS
        )
        slope = np.abs(sums(positive, of_p) + sums(unlabelled, of_u))
        slope[active] = 0
        more = np.flatnonzero(slope > penalty * 1.01)
        if not len(more):
            break
        active = np.union1d(active, more)
    else:
        weights, *_ = _fitted(active, positive, unlabelled, prior, penalty, steps)
    return active, weights[:-1], float(weights[-1])


def _fitted(
    active: np.ndarray, positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, penalty: float, steps: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of the active words and the intercept; each row's part in the slope of its words, positive and unlabelled."""

    def matrix(rows):
        found = np.zeros((len(rows), len(active) + 1), dtype=np.float32)
        for i, r in enumerate(rows):
            found[i, np.flatnonzero(np.isin(active, r))] = 1
        found[:, -1] = 1
        return found

    x_p, x_u = matrix(positive), matrix(unlabelled)
    # A bound of the curvature, by power iteration.
    v, norm = np.ones(x_u.shape[1], dtype=np.float32), 1.0
    for _ in range(20):
        v = x_u.T @ (x_u @ v) / len(x_u) + prior * (x_p.T @ (x_p @ v)) / len(x_p)
        norm = float(np.linalg.norm(v)) or 1.0
        v /= norm
    step = 2.0 / norm
    weights = np.zeros(x_u.shape[1])
    weights[-1] = np.log(prior / (1 - prior))
    ahead, momentum = weights, 1.0
    for _ in range(steps):
        f_p, f_u = x_p @ ahead, x_u @ ahead
        negative = np.logaddexp(0, f_u).mean() - prior * np.logaddexp(0, f_p).mean()
        # Derivatives of loss(-f) and loss(f), for the logistic loss.
        of_negative = x_u.T @ _sigmoid(f_u) / len(x_u) - prior * (x_p.T @ _sigmoid(f_p)) / len(x_p)
        of_positive = prior * (x_p.T @ (_sigmoid(f_p) - 1)) / len(x_p)
        slope = of_positive + of_negative if negative >= 0 else -of_negative
        new = ahead - step * slope
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / following * (new - weights)
        weights, momentum = new, following
    f_p, f_u = x_p @ weights, x_u @ weights
    of_p, of_u = -prior * _sigmoid(f_p) / len(x_p), _sigmoid(f_u) / len(x_u)
    if np.logaddexp(0, f_u).mean() >= prior * np.logaddexp(0, f_p).mean():
        return weights, of_p + prior * (_sigmoid(f_p) - 1) / len(x_p), of_u
    return weights, -of_p, -of_u


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    toxic_col: str = "toxic",
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    members: int = MEMBERS,
) -> dict[int, float] | float:
    """Averaged weights by bucket and the intercept, or the prior alone if there are no positives to learn from. Pass only rows to learn from."""
    marks = labels.select(F.col(label_id_col).cast("long").alias("id"), F.col(toxic_col).cast("int").alias("toxic"))
    marks = marks.where("id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    seen = marks.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    prior = (seen.toxic or 0) / seen.n if seen.n else 0.0
    if not 0 < prior < 1:
        return prior
    def draw(*what):
        return F.pmod(F.xxhash64(*what, F.lit("toxicity")), F.lit(1 << 30)) / F.lit(float(1 << 30))

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    chosen = marks.where((F.col("toxic") == 1) & (draw("id") < positives / seen.toxic)).select("id")
    # Rows that share an id share its label: beyond twice the bound, a second draw goes by id and text.
    rows = texts.join(F.broadcast(chosen), "id")
    found = rows.select("id").count()
    if found > 2 * positives:
        rows = rows.where(draw("id", "text") < 2 * positives / found)
    # Rows that repeat whole fall in or out together: they count once.
    toxic = rows.distinct().withColumn("member", F.explode(F.sequence(F.lit(0), F.lit(members - 1))))
    n = texts.count()
    share = min(1 / members, unlabelled / max(n, 1))
    other = texts.withColumn("member", F.floor(draw("id", "text") / share).cast("int")).where(F.col("member") < members).distinct()

    def featured(batch):
        yield {
            "member": batch.column(0), "id": batch.column(1), "toxic": batch.column(2),
            "buckets": [features(t) for t in batch.column(3).to_pylist()],
        }

    sample = map_batches(
        toxic.select("member", "id", F.lit(1).alias("toxic"), "text").unionAll(
            other.select("member", "id", F.lit(0).alias("toxic"), "text")
        ),
        featured,
        "member int, id long, toxic int, buckets array<int>",
    )

    def one(group: pd.DataFrame) -> pd.DataFrame:
        # A fixed order, so that a repeated task gives the same weights.
        rows = sorted(zip(group["toxic"], group["id"].fillna(-1), map(tuple, group["buckets"])))
        sets = [[np.array(b, dtype=np.int64) for t, _, b in rows if t == kind] for kind in (1, 0)]
        buckets, weights, start = train(*sets, prior) if all(sets) else ([], [], None)
        return pd.DataFrame({"buckets": [list(buckets)], "weights": [list(weights)], "start": [start]})

    kind = "buckets array<int>, weights array<double>, start double"
    trained = [r for r in sample.groupBy("member").applyInPandas(one, kind).collect() if r.start is not None]
    if not trained:
        return prior
    # Summed in a fixed order, whichever member came first.
    model: dict[int, list[float]] = {}
    for r in trained:
        for b, w in zip(r.buckets, r.weights):
            model.setdefault(b, []).append(w)
    means = {b: sum(sorted(w)) / len(trained) for b, w in model.items()}
    return {b: w for b, w in means.items() if w} | {INTERCEPT: sum(sorted(r.start for r in trained)) / len(trained)}


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    toxic_col: str = "toxic",
) -> DataFrame:
    """The toxicity of each document, learned from those that are not held out.

    Null texts count as empty; an empty text gets the score of the intercept.
    Of several labels of a document the highest counts, null labels and ids do
    not; a null id is not held out. Without toxic labels, or with no others,
    every score is the prior. Repeated rows give a row each, an empty table an
    empty result; other columns are ignored.

    Returns doc_id, held_out, score, predicted.
    """
    out = F.coalesce(held_out(id_col), F.lit(False))
    learn = labels.where(~F.coalesce(held_out(label_id_col), F.lit(False)))
    model = fit(docs.where(~out), learn, id_col, text_col, label_id_col, toxic_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cache: dict[str, float] = {}

    def score_batch(batch):
        weights, scores = shared.value, []
        for text in batch.column(2).to_pylist():
            if isinstance(weights, float):
                scores.append(weights)
                continue
            if len(cache) > 300_000:
                cache.clear()
            own = set(words(text))
            for w in own.difference(cache):
                cache[w] = weights.get(bucket(w), 0.0)
            total = weights[INTERCEPT] + sum(sorted(filter(None, map(cache.__getitem__, own))))
            scores.append(float(_sigmoid(np.float64(total))))
        yield {"doc_id": batch.column(0), "held_out": batch.column(1), "score": scores}

    slim = docs.select(F.col(id_col).alias("doc_id"), out.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(slim, score_batch, f"doc_id {kind}, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
