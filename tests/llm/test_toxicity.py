import random
import zlib

import numpy as np

from tests.llm import edges
from tidemark.llm.toxicity import features, toxicity, train

# Words of letters alone.
DIGITS = str.maketrans("0123456789", "abcdefghij")

BAD = ["vile", "nasty", "awful", "foul"]


def _corpus(n=900):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.15
        words = [f"w{chr(97 + rng.randint(0, 25))}{chr(97 + rng.randint(0, 25))}" for _ in range(rng.randint(5, 60))]
        if toxic:
            words[1:1] = rng.choices(BAD, k=5)
        docs.append((i, " ".join(words), "en", "s"))
        if rng.random() < 0.5:
            labels.append((i, int(toxic)))
    return docs, labels, {d[0]: any(w in BAD for w in d[1].split()) for d in docs}


def test_held_out_and_edges(spark):
    docs, labels, truth = _corpus()
    rows = docs + [(r[0] + 5000 if r[0] else None, *r[1:]) for r in edges.ROWS]
    marks = spark.createDataFrame(labels + [(None, 1), (1, None), (labels[0][0], 0)], "doc_id long, toxic int")
    got = toxicity(edges.documents(spark, rows), marks).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    unseen = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(bool(r.predicted) == truth[r.doc_id] for r in unseen) >= 0.97 * len(unseen)
    assert all(r.predicted == 0 for r in got if r.doc_id is None or r.doc_id >= 5000)


def test_nothing_to_learn_from(spark):
    docs = edges.documents(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity(docs, none).collect()} == {0.0}
    assert toxicity(edges.empty(spark), none).collect() == []
    some = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    assert toxicity(edges.empty(spark), some).collect() == []


def test_rare_toxic_documents_are_found():
    """At a prior of 0.7 percent, each telling word in a quarter of the toxic documents."""
    rng = random.Random(8)
    prior, telling = 0.007, [f"bad{i}" for i in range(10)]

    def text(toxic):
        words = [f"w{int(rng.paretovariate(0.7)) % 2000}" for _ in range(40)]
        return features(" ".join(words + (rng.choices(telling, k=4) if toxic else [])).translate(DIGITS))

    rows = lambda n, toxic: [np.array(text(toxic()), dtype=np.int64) for _ in range(n)]
    model = train(rows(600, lambda: True), rows(4000, lambda: rng.random() < prior), prior)
    weights = dict(zip(model[0].tolist(), model[1]))
    score = lambda r: model[2] + sum(weights.get(int(b), 0.0) for b in r)
    assert sum(score(r) > 0 for r in rows(200, lambda: True)) >= 150
    assert sum(score(r) > 0 for r in rows(2000, lambda: False)) <= 10


def test_penalty_does_not_depend_on_the_prior():
    rows = lambda n, share: [np.array([1, 2] if i < share * n else [2], dtype=np.int64) for i in range(n)]
    for prior in (0.003, 0.01, 0.1):
        assert 1 in train(rows(400, 0.3), rows(800, 0.3 * prior), prior)[0]
