"""Substring deduplication over sliding spans of sentences.

Each text is cut into sentences and every run of at least ``RUN`` consecutive
sentences, extended until it has ``MIN_WORDS`` words, is hashed (96 bits). A
task compares the runs of each batch of documents first and sends one occurrence
of a run on. One window over all that were sent ranks the occurrences of each
run by id and text: the first document keeps its first occurrence, all others
are told that theirs are repeats, and the sentences they cover are removed.

Sentences longer than ``MAX_WORDS`` are cut into pieces where the hash of two
neighbouring words says so. The cuts of a passage are the same whatever stands
before it, so a repeated passage is found without punctuation and with ends
that differ.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import cut, join_counted, map_batches

RUN = 2
MAX_WORDS = 16
MIN_WORDS = 12
# A long sentence is cut between one in so many pairs of words.
CUT_ONE_IN = 8
# Null ids come last in the order of documents.
_LAST = (1 << 63) - 1

# A sentence ends at a line's end, and at one of these marks if white space follows.
_END = re.compile(r"[.!?\n]\s*")
_WORD = re.compile(r"\S+")


class _Hashes(dict):
    """Hashes of the words met so far, by worker."""

    def __missing__(self, word: str) -> int:
        self[word] = found = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return found


_hashes = _Hashes()
_CACHE = 500_000


def pieces(words: list[str], most: int) -> Iterator[tuple[int, int]]:
    """(first, end) of the pieces of a long sentence, none of more than ``most`` words."""
    if len(_hashes) > _CACHE:
        _hashes.clear()
    own = [_hashes[w] for w in words]
    first = 0
    for i, (a, b) in enumerate(zip(own, own[1:]), 1):
        if (a // CUT_ONE_IN + b) % CUT_ONE_IN == 0 or i - first >= most:
            yield first, i
            first = i
    yield first, len(words)


def sentences(text: str | None, max_words: int = MAX_WORDS) -> list[tuple[int, int, int, str]]:
    """(start, end, words, lowered words joined by spaces) of each sentence or piece, in code points."""
    found, start = [], 0
    if not text:
        return found
    for stop, after in [*(m.span() for m in _END.finditer(text)), (len(text), len(text))]:
        if stop < len(text) and text[stop] != "\n":
            stop += 1
            if stop == after < len(text):
                continue
        part = text[start:stop]
        split = part.lower().split()
        if len(split) > max_words:
            as_is = part.split()
            if " ".join(as_is) == part.strip():  # one space between words: their lengths tell where they are
                at, begins = start + len(part) - len(part.lstrip()), None
            else:
                begins = [m.span() for m in _WORD.finditer(part)]
            for i, j in pieces(split, max_words):
                if begins is None:
                    end = at + len(" ".join(as_is[i:j]))
                    found.append((at, end, j - i, " ".join(split[i:j])))
                    at = end + 1
                else:
                    found.append((start + begins[i][0], start + begins[j - 1][1], j - i, " ".join(split[i:j])))
        elif split:
            lead = len(part) - len(part.lstrip())
            found.append((start + lead, start + len(part.rstrip()), len(split), " ".join(split)))
        start = after
    return found


def spans(found: list[tuple[int, int, int, str]], run: int, min_words: int) -> Iterator[tuple[int, int]]:
    """(first, end) of each run: ``run`` consecutive sentences and as many more as make ``min_words`` words."""
    ahead = [0, *accumulate(f[2] for f in found)]
    end = run
    for i in range(len(found) - run + 1):
        end = max(end, i + run)
        while ahead[end] - ahead[i] < min_words:
            if end == len(found):
                return  # nor do later ones have enough words
            end += 1
        yield i, end


def runs(found: list[tuple[int, int, int, str]], run: int, min_words: int) -> Iterator[tuple[int, bytes]]:
    """(position, 128-bit hash) of each run."""
    texts = [f[3] for f in found]
    for i, end in spans(found, run, min_words):
        yield i, xxhash.xxh3_128_digest("\n".join(texts[i:end]).encode("utf-8", "surrogatepass"))


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    run: int = RUN,
    min_words: int = MIN_WORDS,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """Each document without the sentences that a repeated run covers, first occurrences excepted.

    The first occurrence of a run is the earliest in the document with the
    smallest id; null ids come last, and equal ids (null ones too) are ordered
    by a hash of their texts. Rows that repeat both id and text cannot be told
    apart and count as one: none takes a run from the other. Case and white
    space within a sentence do not matter. Null texts stay null; empty ones, and
    those without a run, stay as they are. An empty table gives an empty result,
    other columns are ignored.

    Returns doc_id, n_sentences, n_removed, removed (start:end of the removed
    sentences in code points, comma-joined) and text (what is left, each
    sentence with the white space that followed it).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select(
        "doc_id", F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("key"), "text"
    )

    def hashed(batch):
        first: dict[bytes, tuple[int, int, int]] = {}
        repeats: dict[tuple[int, int], set[int]] = {}
        met = set()
        for d, own, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (d, own) in met:
                continue
            met.add((d, own))
            for i, digest in runs(sentences(text, max_words), run, min_words):
                here = (d, own, i)
                best = first.setdefault(digest, here)
                if best is here:
                    continue
                if here < best:  # a repeat whatever other texts hold
                    first[digest], here = here, best
                repeats.setdefault(here[:2], set()).add(here[2])
        digests = np.frombuffer(b"".join(first), dtype="<i8").reshape(-1, 2)
        doc, key, pos = zip(*first.values()) if first else ((), (), ())
        yield {
            "h1": pa.array(np.ascontiguousarray(digests[:, 0])),
            "h2": pa.array(digests[:, 1].astype("<i4")),
            "doc": doc,
            "key": key,
            "pos": pos,
            "known": [None] * len(doc),
        }
        if repeats:
            doc, key = zip(*repeats)
            n = len(doc)
            known = [sorted(v) for v in repeats.values()]
            yield {"h1": key, "h2": [None] * n, "doc": doc, "key": key, "pos": [None] * n, "known": known}

    def cleaned(batch):
        columns = {n: [] for n in ("doc_id", "n_sentences", "n_removed", "removed", "text")}
        for d, text, repeats in zip(*(batch.column(i).to_pylist() for i in range(3))):
            found = sentences(text, max_words)
            ends = dict(spans(found, run, min_words)) if repeats else {}
            out = {j for i in repeats or () for j in range(i, ends[i])}
            # Up to the next sentence belongs to a sentence; what precedes the first stays.
            begins = [f[0] for f in found] + [len(text or "")]
            left = text if not out else text[: begins[0]] + "".join(
                text[begins[i] : begins[i + 1]] for i in range(len(found)) if i not in out
            )
            columns["doc_id"].append(d)
            columns["n_sentences"].append(len(found))
            columns["n_removed"].append(len(out))
            columns["removed"].append(",".join(f"{found[i][0]}:{found[i][1]}" for i in sorted(out)))
            columns["text"].append(left)
        yield columns

    # Texts are cut and hashed once, runs are shuffled once. A batch sends one row of a run at most, so even a
    # run of all documents has few rows; what a batch knows to be a repeat goes with them as one list a document.
    kind = "h1 long, h2 int, doc long, key long, pos int, known array<int>"
    found = map_batches(rows.select("doc", "key", "text"), hashed, kind)
    place = F.rank().over(Window.partitionBy("h1", "h2").orderBy("doc", "key"))
    later = found.withColumn("place", place).where("place > 1 or known is not null")
    starts = (
        later.select("doc", "key", F.explode(F.coalesce("known", F.array("pos"))).alias("pos"))
        .groupBy("doc", "key")
        .agg(F.collect_set("pos").alias("repeats"))
    )
    sizes = rows.groupBy("doc", "key").agg(F.count("*").alias("rows"))
    # Rows that repeat whole meet their list split by where they stand.
    met = join_counted(
        rows.withColumn("row", F.monotonically_increasing_id()),
        cut(starts.join(sizes, ["doc", "key"])), ["doc", "key"], "rows", F.col("row"), how="left",
    )
    return map_batches(
        met.select("doc_id", "text", "repeats"),
        cleaned,
        "doc_id long, n_sentences long, n_removed long, removed string, text string",
    )
