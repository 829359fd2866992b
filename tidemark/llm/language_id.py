"""Language identification by words first, then shorter and shorter character n-grams.

A word the model knows is scored by its log frequency in each language. A word
it does not know is scored by the longest n-grams of its letters of which any
is known, down to single letters: the mean of their log frequencies. The text's
score of a language is the sum over its words; the result is the language with
the highest, with its posterior under equal priors.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import groupby

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import fresh, map_batches

MAX_N = 5
# The model is fitted on about so many documents of each language (all, if there
# are fewer), chosen by a hash of id and text; a word or n-gram seen once is not learned.
DOCS_PER_LANG = 2500
MIN_COUNT = 2
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
_SMOOTH = 0.1
_CACHE = 200_000
_FOLDS = 3


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % _FOLDS == 1


def words(text: str | None) -> list[str]:
    """Lowered runs of letters."""
    found = _WORD.findall(text.lower()) if text else []
    if found and not "".join(found).isalpha():  # numerals such as those of Rome or one half
        found = ["".join(run) for w in found for letters, run in groupby(w, str.isalpha) if letters]
    return found


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word with its edges marked; single letters go without."""
    if n == 1:
        return list(word)
    edged = f"<{word}>"
    return [edged[i : i + n] for i in range(len(edged) - n + 1)]


class Model:
    """Log frequencies per language; level 0 has the words, level n the n-grams."""

    def __init__(self, counts: list[tuple[int, str, str, int]], max_n: int = MAX_N) -> None:
        self.langs = sorted({lang for _, lang, _, _ in counts})
        index = {lang: i for i, lang in enumerate(self.langs)}
        self.max_n = max_n
        self.levels: list[dict[str, np.ndarray]] = []
        self.floor: list[np.ndarray] = []
        for level in range(max_n + 1):
            table: dict[str, np.ndarray] = defaultdict(lambda: np.full(len(self.langs), _SMOOTH))
            for at, lang, gram, n in counts:
                if at == level:
                    table[gram][index[lang]] += n
            totals = sum(table.values(), np.full(len(self.langs), _SMOOTH))
            self.levels.append({g: np.log(c / totals) for g, c in table.items()})
            self.floor.append(np.log(_SMOOTH / totals))
        self._forget()

    def _forget(self) -> None:
        """Empty the table of words met so far: the row of each and the rows."""
        self.row: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.langs)))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("row", "rows")}

    def __setstate__(self, state):
        self.__dict__ |= state
        self._forget()

    def _learn_rows(self, words: list[str]) -> None:
        for w in words:
            if len(self.row) == len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[len(self.row)] = self._back_off(w)
            self.row[w] = len(self.row)

    def _back_off(self, word: str) -> np.ndarray:
        if (found := self.levels[0].get(word)) is not None:
            return found
        for n in range(self.max_n, 0, -1):
            own = grams(word, n)
            hits = [self.levels[n].get(g) for g in own]
            if any(h is not None for h in hits):
                return sum((self.floor[n] if h is None else h for h in hits), np.zeros(len(self.langs))) / len(hits)
        return np.zeros(len(self.langs))

    def predict(self, text: str | None) -> tuple[str, float]:
        found = words(text)
        if not found or not self.langs:
            return UNKNOWN, 0.0
        seen = Counter(found)
        if len(self.row) > _CACHE:
            self._forget()
        self._learn_rows([w for w in seen if w not in self.row])
        total = np.fromiter(seen.values(), float, len(seen)) @ self.rows[[self.row[w] for w in seen]]
        best = int(total.argmax())
        return self.langs[best], float(1 / np.exp(np.minimum(total - total[best], 0)).sum())


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_lang: int = DOCS_PER_LANG,
    max_n: int = MAX_N,
) -> Model:
    """A model from the rows with a language; the caller leaves out what is held out.

    ``docs_per_lang`` bounds the sample of each language in expectation; the
    counting itself is a Spark job and only learned counts reach the driver.
    """
    labelled = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where("lang is not null and text is not null")
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], max_n)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, docs_per_lang / n))])
    draw = F.pmod(F.xxhash64("id", "text", F.lit("language")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Rows that repeat whole fall in or out together: they count once.
    sample = labelled.where(draw < share[F.col("lang")]).distinct().select("text", "lang")

    def count(batch):
        seen: Counter = Counter()
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = Counter(words(text))
            for w, n in own.items():
                seen[0, lang, w] += n
                for k in range(1, max_n + 1):
                    for g in grams(w, k):
                        seen[k, lang, g] += n
        keys = list(seen)
        yield {
            "level": [k[0] for k in keys], "lang": [k[1] for k in keys], "gram": [k[2] for k in keys],
            "n": [seen[k] for k in keys],
        }

    counted = (
        map_batches(sample, count, "level int, lang string, gram string, n long")
        .groupBy("level", "lang", "gram")
        .agg(F.sum("n").alias("n"))
        .where((F.col("n") >= MIN_COUNT) | (F.col("level") == 1))
    )
    return Model([tuple(r) for r in counted.sort("level", "lang", "gram").toLocalIterator()], max_n)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with columns lang_pred and score in front of its own (named anew if taken)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batch):
        found = [shared.value.predict(t) for t in batch.column(0).to_pylist()]
        rest = {n: batch.column(i + 1) for i, n in enumerate(names)}
        yield {lang: [f[0] for f in found], score: [f[1] for f in found], **rest}

    lang, score, bare = fresh(docs, "lang_pred"), fresh(docs, "score"), fresh(docs, "_text")
    schema = T.StructType(
        [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType()), *docs.schema.fields]
    )
    return map_batches(docs.select(F.col(text_col).cast("string").alias(bare), "*"), run, schema)


def language_id(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = DOCS_PER_LANG
) -> DataFrame:
    """The language of each document, learned from those that are not held out.

    ``und`` with score 0 if a text is null or has no letter, or nothing could be
    learned. A null id is not held out. Texts without any letter the model
    knows get equal posteriors and the first language in order. Repeated rows
    give a row each; an empty table gives an empty result; other columns are
    ignored.

    Returns doc_id, held_out, lang_pred, score.
    """
    out = F.coalesce(held_out(id_col), F.lit(False))
    model = fit(docs.where(~out), id_col, text_col, lang_col, docs_per_lang)
    slim = docs.select(F.col(id_col).alias("doc_id"), out.alias("held_out"), F.col(text_col).alias("text"))
    return predict(slim, model).select("doc_id", "held_out", "lang_pred", "score")


def drop_unrecognised(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    least_score: float = 0.5,
    docs_per_lang: int = DOCS_PER_LANG,
) -> DataFrame:
    """``docs`` with all its columns, without those of no recognised language (``und`` or below ``least_score``)."""
    model = fit(docs, id_col, text_col, lang_col, docs_per_lang)
    names = docs.columns
    found = predict(docs, model, text_col)
    lang, score = found.columns[:2]
    return found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= least_score)).select(*names)
