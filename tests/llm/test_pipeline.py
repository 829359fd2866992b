from functools import partial

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tests.llm import brute, edges
from tests.llm.test_source_mixing import plain as raked
from tidemark.llm.source_mixing import FRACTION, GENERAL, TOPICS, mixed_sample

SF_DIR = "/root/testdata/sf0.001"
SWEEPS = 2


def _read(name, *columns):
    return pq.read_table(f"{SF_DIR}/{name}.parquet", columns=list(columns)).to_pylist()


def _unique(rows):
    best = {}
    for doc, text in rows:
        key = (text or "").encode().lower()
        if key not in best or (doc is not None and (best[key][0] is None or doc > best[key][0])):
            best[key] = (doc, text)
    return sorted(best.values(), key=str)


def _near(rows):
    found, kept = brute.simhash_groups(rows), []
    groups = {}
    for (doc, text), (_, _, component) in zip(rows, found):
        groups.setdefault(component, []).append((doc, text))
    for component, members in groups.items():
        kept.append(min((m for m in members if m[0] == component), key=lambda m: str(m[1])))
    return sorted(kept, key=str)


def _clean(rows):
    items = [(n, brute.grams(r["text"], n)) for r in _read("benchmark", "text") if (n := min(5, len(brute.words(r["text"]))))]
    return [(d, t) for d, t in rows if not any(len(g & brute.grams(t, n)) >= 0.8 * len(g) for n, g in items)]


def _topic(text):
    counts = {name: sum((text or "").lower().count(s) for s in stems) for name, stems in TOPICS.items()}
    best = max(counts.values())
    return next(name for name, n in counts.items() if n == best) if best else GENERAL


def test_stages_equal_brute_force(spark, monkeypatch):
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "simhash_dedup", "decontamination", "source_mixing"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = [(r["doc_id"], r["text"]) for r in _read("documents", "doc_id", "text")]
    for (name, stage), plain in zip(pipeline.STAGES[:4], (list, _unique, _near, _clean)):
        columns, docs = docs.columns, stage(spark, docs, SF_DIR).checkpoint()
        assert docs.columns == columns
        want = plain(want)
        assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=str) == sorted(want, key=str), name
    rows = docs.select("*", (F.pmod(F.xxhash64("doc_id", "text", F.lit("mix")), F.lit(1 << 53)) / float(1 << 53)).alias("u"))
    facts = {
        r.doc_id: (r.source or "", r.lang or "", _topic(r.text), len((r.text or "").encode().split()), r.u) for r in rows.collect()
    }
    odds = raked([f[:4] for f in facts.values()], FRACTION, SWEEPS)
    # The stage itself; so few documents leave cells missing, and raking would go on to its bound.
    monkeypatch.setattr(pipeline, "mixed_sample", partial(mixed_sample, max_sweeps=SWEEPS))
    mixed = pipeline.STAGES[4][1](spark, docs, SF_DIR)
    got = {r.doc_id: r for r in mixed.collect()}
    near = {d for d, f in facts.items() if abs(f[4] - odds[f[:3]][1]) < 2e-2}
    assert set(got) ^ {d for d, f in facts.items() if f[4] < odds[f[:3]][1]} <= near and len(near) < 0.1 * len(facts)
    for d, r in got.items():
        weight, probability = odds[facts[d][:3]]
        assert (r.topic, r.tokens) == facts[d][2:4]
        assert r.weight == pytest.approx(weight, abs=1e-3) and r.probability == pytest.approx(probability, abs=2e-2)


def test_run_writes_what_each_stage_kept(spark, monkeypatch):
    read = []
    stages = [(n, lambda spark, docs, sf_dir, n=n: (read.append((n, docs.inputFiles())), docs)[1]) for n, _ in pipeline.STAGES]
    monkeypatch.setattr(pipeline, "STAGES", stages)
    assert pipeline.run(spark, SF_DIR).count() == len(_read("documents", "doc_id"))
    assert [n for n, _ in read] == [n for n, _ in stages]
    assert all(f"/pipeline-{before[0]}-" in files[0] for before, (_, files) in zip(stages, read[1:]))


@pytest.mark.parametrize("rows", [edges.ROWS, []])
def test_oddities_pass_through(spark, rows):
    docs = edges.documents(spark, rows) if rows else edges.empty(spark)
    for name, stage in pipeline.STAGES[:4]:
        columns, docs = docs.columns, stage(spark, docs, SF_DIR).checkpoint()
        assert docs.columns == columns, name
    assert docs.count() == len({(r.doc_id, r.text) for r in docs.collect()})
    if rows:  # texts without letters go; of equal texts, one stays
        assert {1, 2, 6, 8} <= {r.doc_id for r in docs.collect()} <= {1, 2, 6, 7, 8, 10, 11}
