"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short and documents may be long, so what counts is containment:
the share of an item's shingles that a document holds. Items are partitioned by
size in powers of two. The MinHash sketch of an item is its k smallest shingle
hashes, with k = n - ceil(t n) + 1 taken at the largest size n of its partition:
a document that holds a share t of the item cannot miss all of so many, so the
search finds every one, however long the document. A document is a candidate
for an item if it holds a hash of the sketch and is itself not too small for
the item's partition; candidates are verified by exact containment of the
shingles as words.

Items are read in blocks of bounded size; documents stream past each block, one
task at a time, without a shuffle. Nothing depends on how often a passage occurs.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import fresh, map_batches, words_of

SHINGLE = 5
THRESHOLD = 0.8
# An item block broadcast to the tasks has about so many bytes of text.
BLOCK_BYTES = 32 << 20
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(64)], dtype=np.uint64)


def shingle_hashes(words: list[bytes], n: int, cache: dict[bytes, int]) -> np.ndarray:
    """One 64-bit hash for each run of ``n`` words, from the hashes of the words."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    if len(cache) > 1 << 18:
        cache.clear()
    for w in set(words).difference(cache):
        cache[w] = xxhash.xxh64_intdigest(w)
    single = np.array([cache[w] for w in words], dtype=np.uint64)
    last = len(words) - n + 1
    total = np.zeros(last, dtype=np.uint64)
    for i in range(n):
        total += single[i : i + last] * _POWERS[i]
    return total ^ (total >> np.uint64(29))


class Sketches:
    """The items of one block by length of shingles and size partition: sketch hashes to look up, shingles to verify with.

    An item of fewer words than a shingle is one shingle of all its words.
    """

    def __init__(self, items: list[tuple[int | None, bytes]], shingle: int, threshold: float) -> None:
        self.threshold = threshold
        self.ids: list[int | None] = []
        self.grams: list[set[bytes]] = []
        sketches: dict[int, list[tuple[np.ndarray, int]]] = {}
        sizes = []
        cache: dict[bytes, int] = {}
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            length = min(shingle, len(words))
            grams = {b" ".join(words[i : i + length]) for i in range(len(words) - length + 1)}
            top = (1 << len(grams).bit_length()) - 1  # the largest size of the partition
            k = top - ceil(threshold * top - 1e-9) + 1
            sketch = np.sort(np.unique(shingle_hashes(words, length, cache)))[:k]
            sketches.setdefault(length, []).append((sketch, len(self.ids)))
            # The smallest document that can hold enough of any item of the partition.
            sizes.append(ceil(threshold * ((top + 1) // 2) - 1e-9))
            self.ids.append(item)
            self.grams.append(grams)
        self.least = np.array(sizes, dtype=np.int64)
        # By length: hashes in order, the item of each, and the distinct hashes.
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length, found in sorted(sketches.items()):
            hashes = np.concatenate([h for h, _ in found])
            owners = np.concatenate([np.full(len(h), at) for h, at in found])
            order = np.argsort(hashes, kind="stable")
            self.tables[length] = hashes[order], owners[order], np.unique(hashes)

    def matches(self, text: bytes | None, cache: dict[bytes, int]) -> list[tuple[int | None, int, int]]:
        """(item id, shingles found, shingles of the item) of the items that ``text`` contains."""
        words, found = words_of(text), []
        for length, (hashes, owners, distinct) in self.tables.items():
            own = shingle_hashes(words, length, cache)
            if not own.size:
                continue
            at = np.searchsorted(distinct, own)
            at[at == len(distinct)] = 0
            hit = np.unique(own[distinct[at] == own])
            if not hit.size:
                continue
            lo, hi = np.searchsorted(hashes, hit), np.searchsorted(hashes, hit, side="right")
            candidates = np.unique(np.concatenate([owners[a:b] for a, b in zip(lo, hi)]))
            grams = {b" ".join(words[i : i + length]) for i in range(len(words) - length + 1)}
            for c in candidates[self.least[candidates] <= len(grams)]:
                shared, size = len(self.grams[c] & grams), len(self.grams[c])
                if shared >= self.threshold * size - 1e-9:
                    found.append((self.ids[c], shared, size))
        return found


def _blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The items in blocks of about ``block_bytes`` of text, each as a driver-side list."""
    slim = items.select(
        F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("text")
    ).where("text is not null")
    size = slim.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, ceil(size / block_bytes))
    for block in range(blocks):
        part = slim.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield sorted({(r.item_id, bytes(r.text)) for r in part.collect()}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The pairs of a document and a test item of which it holds the share ``threshold`` of distinct word shingles.

    Words are lowered (A-Z only) and cut at spaces and control characters 9 to
    13. An item of fewer words than a shingle is one shingle of all its words,
    and a document holds it or not. Empty or null items and documents match
    nothing. Rows that repeat id and text of an
    item count once; repeated documents give a row each; null ids are carried
    along. Empty tables give an empty result, other columns are ignored.

    Returns doc_id, item_id, shared, item_shingles, containment.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    found = None
    for block in _blocks(items, item_col, item_text_col, block_bytes):
        sketches = docs.sparkSession.sparkContext.broadcast(Sketches(block, shingle, threshold))
        cache: dict[bytes, int] = {}

        def search(batch, sketches=sketches, cache=cache):
            out = [
                (doc, *match)
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for match in sketches.value.matches(text, cache)
            ]
            yield {n: [r[i] for r in out] for i, n in enumerate(("doc_id", "item_id", "shared", "item_shingles"))}

        part = map_batches(slim, search, "doc_id long, item_id long, shared long, item_shingles long")
        found = part if found is None else found.unionByName(part)
    return found.withColumn("containment", F.col("shared") / F.col("item_shingles"))


def drop_leaks(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with all its columns, without the rows that contain a test item."""
    schema, names = docs.schema, docs.columns
    for block in _blocks(items, item_col, item_text_col, block_bytes):
        sketches = docs.sparkSession.sparkContext.broadcast(Sketches(block, shingle, threshold))
        cache: dict[bytes, int] = {}

        def keep(batch, sketches=sketches, cache=cache):
            clean = pa.array([not sketches.value.matches(t, cache) for t in batch.column(0).to_pylist()], pa.bool_())
            batch = batch.filter(clean)
            yield {n: batch.column(i + 1) for i, n in enumerate(names)}

        bare = fresh(docs, "_text")
        docs = map_batches(docs.select(F.col(text_col).cast("binary").alias(bare), "*"), keep, T.StructType(schema.fields))
    return docs
