import random
import re

from pyspark.sql import functions as F

from tests.llm import edges
from tidemark.llm.substring_dedup import MAX_WORDS, MIN_WORDS, RUN, pieces, substring_dedup


def plain(rows):
    """Sentences and removed sentences by (id, text), from the words of all runs held in one dictionary."""
    def cut(text):
        out = []
        for s in re.split(r"(?<=[.!?])\s+|\n+", text or ""):
            w = s.lower().split()
            if w:
                out += [w[i:j] for i, j in pieces(w, MAX_WORDS)] if len(w) > MAX_WORDS else [w]
        return out

    def spans(s):
        for i in range(len(s)):
            j = next((j for j in range(i + RUN, len(s) + 1) if sum(map(len, s[i:j])) >= MIN_WORDS), None)
            if j:
                yield i, j, tuple(map(tuple, s[i:j]))

    orders = {(d, t): (d is None, d or 0, k) for d, t, k in rows}
    cuts = {r: cut(r[1]) for r in orders}
    found = {r: list(spans(s)) for r, s in cuts.items()}
    first = {}
    for r, own in found.items():
        for _, _, key in own:
            first[key] = min(first.get(key, orders[r]), orders[r])
    result = {}
    for r, own in found.items():
        seen, out = set(), set()
        for i, j, key in own:
            if key in seen or first[key] < orders[r]:
                out |= set(range(i, j))
            seen.add(key)
        result[r] = (len(cuts[r]), len(out))
    return result


def _rows():
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefg", k=rng.randint(1, 6)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(2, 9))) + rng.choice(".!?")
    passage = [sentence() for _ in range(6)]
    bare = " ".join(word() for _ in range(60))
    rows = []
    for doc in range(40):
        parts = [sentence() for _ in range(rng.randint(0, 8))]
        if doc % 3 == 0:
            parts[1:1] = [s.upper() for s in passage] if doc % 2 else passage
        if doc % 5 == 0:
            parts.append("\n" + bare + "\n")
        rows.append((doc, rng.choice([" ", "\n"]).join(parts)))
    lines = "\n".join(" ".join(word() for _ in range(3)) for _ in range(20))
    rows += [(50, " ".join(passage * 2)), (50, " ".join(passage * 2)), (50, "Lead. " + bare), (None, " ".join(passage))]
    return rows + [(None, f"{sentence()} {bare}"), (None, lines), (60, "Some lead\n" + lines), (None, lines)]


def test_equals_brute_force(spark):
    rows = _rows() + [(r[0] + 100 if r[0] else None, r[1]) for r in edges.ROWS]
    docs = edges.documents(spark, [(*r, "en", "s") for r in rows])
    want = plain([tuple(r) for r in docs.select("doc_id", "text", F.xxhash64("text")).collect()])
    got = substring_dedup(docs.repartition(3)).collect()
    assert len(got) == len(rows)
    counted = sorted(((r.doc_id, r.n_sentences, r.n_removed) for r in got), key=str)
    assert counted == sorted(((d, *want[d, t]) for d, t in rows), key=str)


def test_what_is_left(spark):
    passage = "One two three four five. Six seven eight nine ten. Eleven twelve thirteen fourteen."
    rows = [(1, f"Start here. {passage} End."), (2, f"Other. {passage}\nTail stays."), (3, "Clean text of its own.")]
    got = {r.doc_id: r for r in substring_dedup(edges.documents(spark, [(*r, "en", "s") for r in rows])).collect()}
    assert [got[i].text for i in (1, 2, 3)] == [rows[0][1], "Other. Tail stays.", rows[2][1]]
    assert got[2].n_removed == 3 and got[2].removed == "7:31,32:57,58:90"


def test_empty(spark):
    assert substring_dedup(edges.empty(spark)).collect() == []


def test_passages_of_over_50_words(spark):
    """Ragged ends, no punctuation, short lines, null ids: most of a passage goes, wherever it begins."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 8)))
    rows = []
    for i in range(0, 400, 2):
        words = [word() for _ in range(rng.randint(51, 80))]
        shape = i % 3
        for at in range(len(words)):
            if shape == 1 and at % 13 == 12:
                words[at] += "."
            if shape == 2 and at % 3 == 2:
                words[at] += "\n"
        for doc in (i, i + 1):
            lead, tail = ([word() for _ in range(rng.randint(1, 30))] for _ in range(2))
            rows.append((doc if i % 8 else None, " ".join([*lead, *words, *tail])))
    got = substring_dedup(edges.documents(spark, [(*r, "en", "s") for r in rows])).collect()
    assert sum(r.n_removed > 0 for r in got) >= 0.98 * 200
    firsts = {i for i in range(0, 400, 2) if i % 8}
    assert all(r.n_removed == 0 for r in got if r.doc_id in firsts)


def test_rows_that_repeat_whole_are_split(spark):
    passage = "One two three four five six. Seven eight nine ten eleven twelve thirteen."
    rows = [(1, passage)] + [(2, f"Other. {passage}")] * 3000 + [(3, "Clean text of its own.")]
    got = substring_dedup(edges.documents(spark, [(*r, "en", "s") for r in rows])).groupBy("doc_id", "n_removed").count()
    assert sorted(map(tuple, got.collect())) == [(1, 0, 1), (2, 2, 3000), (3, 0, 1)]
