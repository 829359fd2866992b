import random
import zlib

import pytest

from tests.llm import edges
from tidemark.llm.language_id import Model, drop_unrecognised, fit, grams, language_id, words

SYLLABLES = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "ung", "ver", "ein"], "cc": ["eau", "oi", "ch", "ré"]}


def _corpus(n=240):
    rng = random.Random(1)
    out = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        word = lambda: "".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4)))  # noqa: B023, E731
        out.append((i, " ".join(word() for _ in range(rng.randint(3, 40))), lang, "s"))
    return out


def test_held_out_accuracy_and_edges(spark):
    rows = _corpus() + [(r[0] + 1000 if r[0] else None, r[1], None, r[3]) for r in edges.ROWS]
    got = language_id(edges.documents(spark, rows)).collect()
    assert len(got) == len(rows)
    lang = {r[0]: r[2] for r in _corpus()}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    known = [r for r in got if r.doc_id is not None and r.doc_id < 1000]
    assert sum(r.lang_pred == lang[r.doc_id] for r in known if r.held_out) >= 0.97 * sum(r.held_out for r in known)
    silent = {1003, 1004, 1005, 1009}
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in silent)
    assert all(r.lang_pred in SYLLABLES and 0 <= r.score <= 1 for r in got if r.doc_id not in silent | {None})


def test_words_first_then_shorter_grams():
    model = Model(
        [(0, "a", "hello", 5), (0, "b", "world", 5), (5, "a", "<hell", 5), (5, "b", "<worl", 5), (2, "a", "ll", 5), (2, "b", "zz", 5)]
        + [(1, "a", "h", 5), (1, "b", "q", 5)]
    )
    assert model.predict("hello")[0] == "a"
    assert model.predict("hells")[0] == "a"  # by its longest known n-gram
    assert model.predict("azza")[0] == "b" and model.predict("qu")[0] == "b"
    assert model.predict("§")[0] == "und" and model.predict("世")[1] == pytest.approx(0.5)
    assert grams("ab", 2) == ["<a", "ab", "b>"] and grams("ab", 1) == ["a", "b"] and grams("a", 5) == []


def test_rejection_keeps_the_recognised(spark):
    rows = _corpus() + [(1000, "123 !!", "aa", "s"), (1001, None, "aa", "s"), (1002, "世 界", "aa", "s")]
    docs = edges.documents(spark, rows)
    kept = drop_unrecognised(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {r[0] for r in _corpus()}
    assert kept.where("doc_id >= 1000 and doc_id < 1002").count() == 0


def test_empty(spark):
    assert language_id(edges.empty(spark)).collect() == [] == drop_unrecognised(edges.empty(spark)).collect()
    unlabelled = edges.documents(spark, [(1, "some words", None, "s")])
    assert [tuple(r)[2:] for r in language_id(unlabelled).collect()] == [("und", 0.0)]


def test_numerals_are_no_letters(spark):
    assert words("½ ² Ⅷ x²y ٣ Œuvre") == ["x", "y", "œuvre"]
    rows = _corpus() + [(2000, "½ ²", None, "s"), (2001, "Ⅷ", None, "s")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id(edges.documents(spark, rows)).collect()}
    assert got[2000] == got[2001] == ("und", 0.0)


def test_draw_is_bounded_by_id_and_text(spark):
    """A third of all rows share the null id: their texts are drawn one by one, whole repeats count once."""
    rows = _corpus(600) + [(None, t, lang, s) for _, t, lang, s in _corpus(300)] + [(None, "ka to mi", "aa", "s")] * 200
    docs = edges.documents(spark, rows)
    model = fit(docs, docs_per_lang=100)
    assert model.langs == ["aa", "bb", "cc"] and model.predict("eauoi chré")[0] == "cc"
