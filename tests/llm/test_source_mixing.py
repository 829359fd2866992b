import random
from collections import defaultdict

import pytest

import corpus_pipeline
from tests.llm import edges
from tidemark.llm import registry
from tidemark.llm.source_mixing import FLATTEN, MARGINS, mix, mixed_sample


def _rows():
    rng = random.Random(6)
    out = []
    for i in range(600):
        words = [rng.choice(["lorem", "ipsum", "dolor"]) for _ in range(rng.randint(1, 30))]
        words += rng.choice([[], ["Copyright"], ["password"], ["me@x.org", "phone"], ["LICENSE", "secret"]])
        out.append((i, " ".join(words), rng.choice(["en", "en", "fr"]), rng.choice(["a", "a", "a", "b", "c"])))
    return out


def plain(facts, fraction, sweeps=200):
    """Weights and probabilities of the cells of (source, lang, topic, tokens) rows."""
    tokens = defaultdict(int)
    for *cell, n in facts:
        tokens[tuple(cell)] += n
    weight = {c: n / sum(tokens.values()) for c, n in tokens.items()}
    goals = []
    for i, m in enumerate(MARGINS):
        raw = defaultdict(int)
        for c, n in tokens.items():
            raw[c[i]] += n
        raw = {v: n ** FLATTEN[m] if n else 0.0 for v, n in raw.items()}
        goals.append({v: r / sum(raw.values()) for v, r in raw.items()})
    for _ in range(sweeps):
        for i in range(3):
            sums = defaultdict(float)
            for c, w in weight.items():
                sums[c[i]] += w
            weight = {c: w * goals[i][c[i]] / sums[c[i]] if sums[c[i]] else 0.0 for c, w in weight.items()}
    lo, hi = 0.0, 1e9
    for _ in range(200):
        mid = (lo + hi) / 2
        got = sum(min(n, w * mid) for (c, n), w in zip(tokens.items(), weight.values()))
        lo, hi = (mid, hi) if got < fraction * sum(tokens.values()) else (lo, mid)
    return {c: (weight[c], min(1.0, weight[c] * lo / n) if n else 1.0) for c, n in tokens.items()}


def test_equals_brute_force(spark):
    rows = _rows()
    docs = edges.documents(spark, rows)
    found = mix(docs, fraction=0.6)
    assert found.columns[: len(docs.columns)] == docs.columns
    got = found.collect()
    topic, tokens, weight, probability, sampled = range(len(docs.columns), len(docs.columns) + 5)
    assert len(got) == len(rows)
    want = plain([(r.source or "", r.lang or "", r[topic], r[tokens]) for r in got], 0.6)
    for r in got:
        w, p = want[r.source or "", r.lang or "", r[topic]]
        assert r[weight] == pytest.approx(w, abs=2e-4) and r[probability] == pytest.approx(p, abs=2e-2)
        assert r[tokens] == len(r.text.split())
    by_id = {r.doc_id: r[topic] for r in got}
    assert all(by_id[i] == ("legal" if "Copyright" in t or "LICENSE" in t else "security" if "password" in t else "contact" if "@" in t else "general") for i, t, *_ in _rows())
    assert sum(r[tokens] for r in got if r[sampled]) == pytest.approx(0.6 * sum(r[tokens] for r in got), rel=0.2)


def test_edges(spark):
    docs = edges.documents(spark)
    found = mix(docs, max_sweeps=2)
    got = found.collect()
    probability = found.columns.index("probability")
    assert sorted((r.doc_id for r in got), key=str) == sorted(edges.ids(), key=str)
    assert all(0 <= r[probability] <= 1 for r in got)
    assert all(r[probability] == 1 for r in got if not r.text and not r.source)
    kept = mixed_sample(docs, max_sweeps=2)
    assert kept.columns[: len(docs.columns)] == docs.columns and kept.count() == sum(r[-1] for r in got)


def test_given_targets(spark):
    docs = edges.documents(spark, _rows())
    targets = {"source": {"a": 0.2, "b": 0.8}, "lang": {"en": 0.5, "fr": 0.5}}
    got = mix(docs, targets=targets, fraction=0.1).select("source", "lang", "probability", "tokens").collect()
    share = defaultdict(float)
    for r in got:
        share[r.source] += r.probability * r.tokens
        share[r.lang] += r.probability * r.tokens
    total = share["en"] + share["fr"]
    assert share["c"] == 0 and share["b"] / total == pytest.approx(0.8, abs=0.01) and share["en"] / total == pytest.approx(0.5, abs=0.01)


def test_tells_when_margins_still_miss(spark):
    rows = [(1, "one two", "en", "a"), (2, "one two", "fr", "b")]  # no cell can serve both margins
    targets = {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.1, "fr": 0.9}}
    with pytest.warns(UserWarning, match="margin off by"):
        mix(edges.documents(spark, rows), targets=targets, max_sweeps=2)


def test_empty(spark):
    assert mix(edges.empty(spark)).collect() == [] == mixed_sample(edges.empty(spark)).collect()


def test_registered_query_and_stage_count_words(spark, tmp_path):
    texts = ["a bb  ccc", "слово " * 7, " \t\n ", "x" * 4000, "one\x0btwo\x0cthree\r\nfour", "", None]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    edges.documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = {i: len((t or "").encode().split()) for i, t in enumerate(texts)}
    got = registry.queries()["op10_source_mixing"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.tokens for r in got} == want
    stage = corpus_pipeline.mixture(spark, edges.documents(spark, rows), str(tmp_path)).collect()
    assert stage and all(r.tokens == want[r.doc_id] for r in stage)
