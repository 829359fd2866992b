import random

import pytest

from tests.llm import brute, edges
from tidemark.llm.decontamination import drop_leaks, find_leaks


def plain(docs, items):
    out = []
    for doc, text in docs:
        for item, item_text in set(items):
            n = min(5, len(brute.words(item_text)))
            g = brute.grams(item_text, n) if n else frozenset()
            shared = len(g & brute.grams(text, n)) if n else 0
            if g and shared >= 0.8 * len(g):
                out.append((doc, item, shared, len(g)))
    return sorted(out, key=str)


def _data():
    rng = random.Random(2)
    words = lambda n: [f"w{rng.randint(0, 400)}" for _ in range(n)]
    items = [(i, " ".join(words(rng.choice([1, 2, 4, rng.randint(3, 60)])))) for i in range(30)] + [(7, None), (8, ""), (None, " ".join(words(9)))]
    items += [items[12], (99, items[12][1])]
    docs = []
    for d in range(120):
        body = words(rng.randint(0, 300))
        for _ in range(rng.randint(0, 2)):
            hit = (rng.choice(items)[1] or "").split()
            for _ in range(rng.randint(0, 2)):  # damage near the threshold
                if hit:
                    hit[rng.randrange(len(hit))] = "damaged"
            at = rng.randint(0, len(body))
            body[at:at] = hit if d % 2 else [w.upper() for w in hit]
        docs.append((d, "  \n".join(body)))
    return docs + [(5, docs[5][1])] + [(r[0], r[1]) for r in edges.ROWS], items


@pytest.mark.parametrize("block_bytes", [1 << 20, 900])
def test_equals_brute_force(spark, block_bytes):
    docs, items = _data()
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = edges.documents(spark, [(*d, "en", "s") for d in docs])
    got = find_leaks(rows, table, block_bytes=block_bytes).drop("containment").collect()
    want = plain(docs, items)
    assert want and sorted(map(tuple, got), key=str) == want
    bad = {(d, t) for d, t in docs if any(w[0] == d for w in plain([(d, t)], items))}
    left = drop_leaks(rows, table, block_bytes=block_bytes)
    assert left.columns == rows.columns
    assert sorted((r.doc_id, len(r.text or "")) for r in left.where("doc_id is not null").collect()) == sorted(
        (d, len(t or "")) for d, t in docs if d is not None and (d, t) not in bad
    )


def test_empty(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(edges.empty(spark), items).collect() == [] == find_leaks(edges.documents(spark), items).collect()
    assert drop_leaks(edges.documents(spark), items).count() == len(edges.ROWS)


def test_short_items_at_their_own_length(spark):
    items = spark.createDataFrame([(1, "the answer is"), (2, "Answer"), (3, "is the answer")], "item_id long, text string")
    docs = edges.documents(spark, [(1, "So THE answer is this.", "en", "s"), (2, "the answers is", "en", "s")])
    got = find_leaks(docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.shared, r.item_shingles) for r in got) == [(1, 1, 1, 1), (1, 2, 1, 1)]
