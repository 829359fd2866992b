import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from tests.llm import brute
from tidemark.llm.components import components
from tidemark.llm.simhash_dedup import drop_near_duplicates, fingerprint, link_prints, simhash_dedup

SCHEMA = "doc_id long, text string, print string"
KEY = lambda r: tuple((v is not None, v) for v in r)


def _ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "print long")


def test_fingerprint_of_edges():
    for text in (None, "", " \t\n", "One", "a b c", "a b c d", "A b C d e\x0bf", "é\x85x y", "x " * 70000):
        assert fingerprint(None if text is None else text.encode()) == brute.simhash(text)


def test_documents_equal_brute_force(spark):
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    rows = [(r["doc_id"], r["text"]) for r in table]
    rows += [(None, None), (None, ""), (7, "a b"), (7, "a b"), (9001, "A  B"), rows[0], (9002, rows[0][1] + " more")]
    got = simhash_dedup(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()
    assert sorted(map(tuple, got), key=KEY) == sorted(brute.simhash_groups(rows), key=KEY)


@pytest.mark.parametrize("max_bucket", [4096, 3])
def test_links_equal_brute_force(spark, max_bucket):
    """A chain, a dense ball and strangers; with a small bucket the neighbourhoods are joined instead."""
    rng = random.Random(5)
    flip = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(64), n))
    prints = {rng.getrandbits(64) for _ in range(60)}
    centre = rng.getrandbits(64)
    prints |= {flip(centre, rng.randint(0, 5)) for _ in range(60)}
    at = rng.getrandbits(64)
    for _ in range(12):
        prints.add(at := flip(at, rng.choice([4, 4, 5])))
    prints = sorted(prints)
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    roots = brute.groups(len(prints), links)
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    edges = link_prints(_ids(spark, signed), max_bucket=max_bucket)
    got = {r.node: r.root for r in components(edges).collect()}
    want = {}
    for s, r in zip(signed, roots):
        want.setdefault(r, set()).add(s)
    for members in want.values():
        assert {got.get(m, m) for m in members} == {min(members)}


def test_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(99, 98), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {98: 98, 99: 98}


def test_one_of_each_group_stays(spark, rows):
    text = " ".join(f"word{i}" for i in range(400))
    data = [(3, text, "a"), (2, text + " end", "b"), (5, "other words here now", "c"), (5, "other words here now", "c")]
    data += [(None, None, "d"), (None, "", "e")]
    kept = rows(drop_near_duplicates(spark.createDataFrame(data, SCHEMA)), "doc_id", "print")
    assert kept == [(None, "d"), (2, "b"), (5, "c")] or kept == [(None, "e"), (2, "b"), (5, "c")]


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash_dedup(empty).collect() == [] and drop_near_duplicates(empty).collect() == []
