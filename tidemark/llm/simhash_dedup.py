"""Near-duplicates by SimHash fingerprints, found with the pigeonring principle.

A fingerprint is cut into one segment more than the largest distance D. If two
fingerprints differ in at most D bits, then, going round the ring of segments,
some segment starts a chain in which every prefix of l segments differs in at
most l - 1 bits. So some segment is equal and the next differs in at most one
bit: each fingerprint is filed under (segment, next segment) for every start,
and looked up under the same keys and those with one bit of the next segment
flipped. What meets under a key must pass the budgets of the whole chain before
the full distance is counted. Keys hold distinct fingerprints only, so copies
are never paired; a key gives edges that span its links, not all its pairs.

A key with more than ``max_bucket`` fingerprints is not compared in pairs: two
fingerprints are within D bits if and only if they share a point within D/2 bits
of both, so all such fingerprints are joined on their neighbourhoods, which
takes rows in proportion to them and misses nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import cut, join_counted, keep_rows, lower_ascii, map_batches
from tidemark.llm.components import components

BITS = 64
SHINGLE = 4
MAX_DISTANCE = 4
MAX_BUCKET = 4096
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles; 0 without words."""
    words = lower_ascii(text).split()
    if not words:
        return 0
    joined = b" ".join(words)
    stops = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *stops[:-1]]
    n = max(1, len(words) - shingle + 1)
    ends = stops[min(shingle, len(words)) - 1 :]
    hashes = np.array(
        [xxhash.xxh64_intdigest(joined[s : e - 1], 42) for s, e in zip(starts[:n], ends)], dtype="<u8"
    )
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        part = hashes[at : at + _CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def segments(max_distance: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment of the ring."""
    m = max_distance + 1
    bounds = [round(i * BITS / m) for i in range(m + 1)]
    return [(lo, hi - lo) for lo, hi in zip(bounds, bounds[1:])]


def _segment(x: np.ndarray, shift: int, width: int) -> np.ndarray:
    return (x >> np.uint64(shift)) & np.uint64((1 << width) - 1)


def chain_keys(prints: np.ndarray, max_distance: int) -> Iterator[tuple[np.ndarray, int]]:
    """(keys, probe) for all starts: the own key with probe 0, those one flipped bit away with probe 1."""
    ring = segments(max_distance)
    for i, first in enumerate(ring):
        second = ring[(i + 1) % len(ring)]
        head = (np.uint64(i) << np.uint64(56)) | (_segment(prints, *first) << np.uint64(second[1]))
        tail = _segment(prints, *second)
        yield head | tail, 0
        for bit in range(second[1]):
            yield head | (tail ^ np.uint64(1 << bit)), 1


def linked(a: np.ndarray, b: np.ndarray, start: int, max_distance: int) -> np.ndarray:
    """Which pairs pass the chain from segment ``start`` and then the full distance, as a matrix."""
    ring = segments(max_distance)
    out = np.empty((len(a), len(b)), dtype=bool)
    for at in range(0, len(a), 256):
        x = a[at : at + 256, None] ^ b[None, :]
        so_far, ok = np.zeros(x.shape, dtype=np.uint8), np.ones(x.shape, dtype=bool)
        for budget in range(max_distance):
            so_far += np.bitwise_count(_segment(x, *ring[(start + budget) % len(ring)]))
            ok &= so_far <= budget
        out[at : at + 256] = ok & (np.bitwise_count(x) <= max_distance)
    return out


def _span(filed: np.ndarray, probes: np.ndarray, start: int, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the links between ``filed``, and from them to ``probes``, connect."""
    nodes = np.concatenate([filed, probes])
    near = linked(filed, nodes, start, max_distance)
    left = near.any(axis=0)
    n, tied = len(filed), []
    while (rest := np.flatnonzero(left[:n])).size:
        root, front = rest[0], rest[:1]
        left[root] = False
        while front.size:
            found = np.flatnonzero(near[front].any(axis=0) & left)
            # Filed rows that only probes connect: from a probe back to its filed neighbours.
            back = near[:, found[found >= n]].any(axis=1) & left[:n] if (found >= n).any() else None
            if back is not None:
                found = np.union1d(found, np.flatnonzero(back))
            left[found] = False
            tied.append((np.full(found.size, root), found))
            front = found[found < n]
    if not tied:
        return filed[:0], filed[:0]
    return nodes[np.concatenate([t[0] for t in tied])], nodes[np.concatenate([t[1] for t in tied])]


def _edges(prints: DataFrame, max_distance: int, max_bucket: int) -> DataFrame:
    """Spanning edges (a, b) of the links; a row with a = b marks a fingerprint of a full bucket."""

    def keys(batch):
        x = batch.column(0).to_numpy().view(np.uint64)
        for key, probe in chain_keys(x, max_distance):
            yield {
                "key": pa.array(key.view(np.int64)),
                "probe": pa.array(np.full(len(x), probe, dtype=np.int8)),
                "print": batch.column(0),
            }

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, filed, full = None, np.zeros(0, dtype=np.uint64), False
        for batch in batches:
            key, probe = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            x = batch.column(2).to_numpy().view(np.uint64)
            if not len(key):
                continue
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            ends = np.r_[starts[1:], len(key)]
            # Alone under a key, or no filed row first: nothing to compare. The first and last may go on.
            busy = (ends - starts > 1) & (probe[starts] == 0)
            busy[0] = busy[-1] = True
            from_, to = [], []
            for s, e in zip(starts[busy], ends[busy]):
                if key[s] != current:
                    current, filed, full = key[s], x[:0], False
                own, probes = x[s:e][probe[s:e] == 0], x[s:e][probe[s:e] == 1]
                if not full and len(filed) + len(own) > max_bucket:
                    full = True
                    from_.append(filed), to.append(filed)
                    filed = x[:0]
                if full:
                    from_.append(x[s:e]), to.append(x[s:e])
                    continue
                filed = np.concatenate([filed, own])
                if len(filed) and len(filed) + len(probes) > 1:
                    a, b = _span(filed, probes, int(key[s]) >> 56, max_distance)
                    from_.append(a), to.append(b)
            if from_:
                a, b = np.concatenate(from_).view(np.int64), np.concatenate(to).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    rows = map_batches(prints.select("print"), keys, "key long, probe byte, print long")
    return (
        rows.repartition("key").sortWithinPartitions("key", "probe").mapInArrow(meet, "a long, b long").distinct()
    )


def _near_points(prints: DataFrame, radius: int) -> DataFrame:
    """(point, print) for every point within ``radius`` bits of a fingerprint."""
    flips = np.array(
        [sum(1 << b for b in some) for r in range(radius + 1) for some in combinations(range(BITS), r)], dtype=np.uint64
    )

    def spread(batch):
        x = batch.column(0).to_numpy().view(np.uint64)
        for at in range(0, len(x), 64):
            part = x[at : at + 64]
            yield {
                "point": pa.array((part[:, None] ^ flips[None, :]).ravel().view(np.int64)),
                "print": pa.array(np.repeat(part, len(flips)).view(np.int64)),
            }

    return map_batches(prints, spread, "point long, print long")


def link_prints(prints: DataFrame, max_distance: int = MAX_DISTANCE, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Edges whose components are those of all links between the distinct long column ``print``."""
    if max_distance % 2 or not 0 < max_distance < 16:
        raise ValueError("max_distance must be even, from 2 to 14")
    edges = cut(_edges(prints, max_distance, max_bucket))
    full = edges.where("a = b").select(F.col("a").alias("print")).distinct()
    if full.isEmpty():
        return edges
    points = _near_points(full, max_distance // 2)
    hubs = cut(points.groupBy("point").agg(F.min("print").alias("least"), F.count("*").alias("n")).where("n > 1"))
    met = join_counted(points, hubs, ["point"], "n", F.col("print"))
    return edges.unionByName(met.select(F.col("print").alias("a"), F.col("least").alias("b"))).where("a <> b").distinct()


def _clusters(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_distance: int, max_bucket: int) -> DataFrame:
    def fingerprints(batch):
        texts = batch.column(1).to_pylist()
        x = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
        yield {
            "doc_id": batch.column(0),
            "print": pa.array(x.view(np.int64)),
            "digest": [hashlib.sha256(lower_ascii(t)).digest() for t in texts],
        }

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    rows = cut(map_batches(slim, fingerprints, "doc_id long, print long, digest binary"))
    prints = cut(rows.groupBy("print").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    roots = cut(components(link_prints(prints, max_distance, max_bucket)).withColumnRenamed("node", "print"))
    linked_prints = prints.join(roots, "print")
    groups = cut(linked_prints.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("members")))
    grouped = join_counted(linked_prints.select("print", "root"), groups, ["root"], "members", F.col("print"))
    by_print = cut(
        prints.join(grouped.withColumn("grouped", F.lit(True)), "print", "left").select(
            "print",
            "n",
            F.coalesce("root", "print").alias("root"),
            F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("first")).alias("component_id"),
        )
    )
    return join_counted(rows, by_print, ["print"], "n", F.xxhash64("doc_id", "digest"))


def simhash_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_distance: int = MAX_DISTANCE,
    max_bucket: int = MAX_BUCKET,
) -> DataFrame:
    """Each document with its fingerprint and the smallest id of the documents it is linked to, in any number of steps.

    Texts are lowered (A-Z only) and cut at spaces and control characters 9 to
    13; a text of fewer words than a shingle is one shingle, and one without
    words, null included, has fingerprint zero and is linked like any other.
    Rows that repeat an id or a text give a row each. Null ids are never the
    smallest; ``component_id`` is null if a group has no other. An empty table
    gives an empty result, other columns are ignored.

    Returns doc_id, fingerprint (16 hex digits), component_id.
    """
    return _clusters(docs, id_col, text_col, shingle, max_distance, max_bucket).select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE
) -> DataFrame:
    """``docs`` with all its columns, one document of each group: the one with the smallest id (then digest)."""
    found = _clusters(docs, id_col, text_col, shingle, max_distance, MAX_BUCKET)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keys = first.groupBy("root", "doc_id").agg(F.min("digest").alias("digest"))
    return keep_rows(docs, keys, id_col, text_col)
