"""Language-model scores by logistic context mixing over bits of words and bytes.

A token is a word or the end of the text. Its first ``CLASS_BITS`` bits are those
of a hash of the word, its class. Each is predicted from contexts over words: none
but the bits before it, the word before, and the two words before. Contexts are
hashed to slots that count zeros and ones over all training texts; the
predictions are mixed in the logistic domain with weights that a gate selects
(the bit's place and how often the contexts were seen), and the mixed
probability is refined adaptively by counts of what followed each level of it.
So the order of the words decides how many bits a text takes.

Within its class a known word takes the bits of its share of the class. A word
never seen gets the share of tokens that new words are expected to have (that of
words seen once) and is spelled byte by byte, closed by a space, by a second
mixer of the same kind, whose contexts are the word's last one, two, three and
four bytes and all of it so far. It is taught by the distinct words of training, each
counted once, as new words resemble rare ones more than frequent ones.

Counts cover all training texts. Each task counts in tables of fixed size, which
are summed in a tree of groups of bounded size; the driver holds the sums. Mixing
weights and refinements are learned from all tokens and all distinct words, with
their own occurrence taken out, then frozen: a score does not depend on which
documents share a task. For the classes, each bit of each token falls in a cell
of its place, the bits before it, the predictions of its contexts (rounded to
``LOGITS``) and how often these were seen; whole counts of the cells are summed,
and the driver finds the weights under which all of them are likeliest. Words are
dealt by their hash, so the parts depend on the words only; each part learns the
speller's weights online bit by bit, and their means count each part by its bits.

Documents meet the facts about their words by a join; words so frequent that
under ``FREQUENT`` of them can exist are broadcast instead, which takes most
tokens out of the shuffle and leaves no hot key in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from math import ceil, log10

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import cut, map_batches

# Slots of the contexts of one, two, three and four bytes and of the whole prefix, as powers of two.
SLOT_BITS = (16, 18, 20, 20, 22)
ORDERS = len(SLOT_BITS)
_FIRST = np.cumsum([0, *(1 << b for b in SLOT_BITS)])
SLOTS = int(_FIRST[-1])
# Bits of a word that are predicted over words, and slots of the contexts: none, one word, two words.
CLASS_BITS = 6
CLASS_SLOT_BITS = (CLASS_BITS, 22, 22)
CLASS_ORDERS = len(CLASS_SLOT_BITS)
_CLASS_FIRST = np.cumsum([0, *(1 << b for b in CLASS_SLOT_BITS)])
CLASS_SLOTS = int(_CLASS_FIRST[-1])
CLASS_GATES = CLASS_BITS * 16
# Predictions as they are counted for learning: exact about even bits, coarse where all but certain.
_HALF = np.concatenate([np.arange(1, 17) * 0.25, 4 + np.arange(1, 16) * 0.75])
LOGITS = np.concatenate([-_HALF[::-1], [0.0], _HALF])
# Cells of a bit: 64 nodes, 64 rounded predictions and 4 levels of having been seen for both contexts, two sides.
CELLS = 1 << (CLASS_BITS + 8 + 8 + 1)
_ROUNDS = 25
# A task that counts slots takes about so many distinct words.
TASK_WORDS = 400_000
GATES = 32
LEVELS = 33
FREQUENT = 200_000
BASE_ALPHA = 0.1
RATE = 0.15
_FOLDS = 10
_CHUNK = 1 << 16
# Tables that meet in one task.
_FAN = 32
# Bytes of words handled at once, and between two corrections of the weights.
_PIECE, _STEP = 1 << 16, 1 << 12
# Bytes of text and tokens handled at once.
_RUN, _FEW = 1 << 20, 1 << 15
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STRIDE = np.uint64(0xD6E8FEB86659FD93)
_SALTS = np.arange(256, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
_INVERSE = np.uint64(pow(int(_STRIDE), -1, 1 << 64))
_KEPT = (np.zeros(0, dtype=np.uint64),) * 2
_IS_GAP = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_START, _BEFORE = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_END = b""


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % _FOLDS == 0


def spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, byte, contexts) of each byte of the words and their closing spaces."""
    flat = np.frombuffer(b"".join(w + b" " for w in words), dtype=np.uint8)
    sizes = np.array([len(w) + 1 for w in words])
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(flat)) - starts[owner]
    contexts = np.empty((ORDERS, len(flat)), dtype=np.uint64)
    recent = np.zeros(len(flat), dtype=np.uint64)
    for order in range(1, ORDERS):
        before = np.zeros(len(flat), dtype=np.uint64)
        before[order:] = flat[:-order].astype(np.uint64) + np.uint64(1)
        before[place < order] = 0
        recent = recent * np.uint64(257) + before
        contexts[order - 1] = recent
    # Each byte is weighed by a power of an odd number, its place in the word: sums are the prefixes' hashes.
    longest = int(sizes.max(initial=1))
    powers = np.cumprod(np.full(longest, _STRIDE, dtype=np.uint64), dtype=np.uint64)
    total = np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * powers[place], dtype=np.uint64)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), total[:-1]])
    contexts[-1] = total - total[starts][owner]
    for order in range(ORDERS):
        contexts[order] = (contexts[order] + np.uint64(order + 1)) * _MIX
    return owner, flat, contexts


def slots_of(contexts: np.ndarray, byte: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The slots of bit ``k`` (0 the highest) in every context, and the bit."""
    x = (contexts ^ _SALTS[(byte >> np.uint8(8 - k) if k else 0) | np.uint8(1 << k)]) * _MIX
    x >>= np.uint64(64) - np.array(SLOT_BITS, dtype=np.uint64)[:, None]
    slots = x.view(np.int64)
    slots += _FIRST[:-1, None]
    return slots, (byte >> np.uint8(7 - k)) & np.uint8(1)


def pieces(words: list[bytes], counts: list[int], piece: int = _PIECE) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Runs of whole words of about ``piece`` bytes."""
    start = size = 0
    for i, w in enumerate(words):
        size += len(w) + 1
        if size >= piece or i == len(words) - 1:
            yield words[start : i + 1], np.array(counts[start : i + 1], dtype=np.float64)
            start, size = i + 1, 0


def _inputs(zeros: np.ndarray, ones: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(inputs of the mixer with a constant one, gate) from the counts in the slots."""
    x = np.empty((ORDERS + 1, zeros.shape[1]))
    np.log((ones + 0.2) / (zeros + 0.2), out=x[:ORDERS])
    x[ORDERS] = 0.3
    seen = zeros[-1] + ones[-1]
    return x, k * 4 + np.searchsorted([1.0, 4.0, 32.0], seen, side="right")


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -20, 20)))


class Mixer:
    """Gated weights, and counts (all, ones) by gate and level of the mixed prediction."""

    def __init__(self, gates: int = GATES, orders: int = ORDERS) -> None:
        self.weights = np.full((gates, orders + 1), 0.3)
        self.refined = np.zeros((gates, LEVELS, 2))
        # Bits each gate has learned from.
        self.learned = np.zeros(gates)

    def mix(self, x: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(mixed probability of a one, its level)."""
        dot = np.zeros(len(gate))
        for i, some in enumerate(x):
            dot += self.weights[:, i][gate] * some
        return _squash(dot), np.rint(np.clip(dot, -8, 8) * 2).astype(np.int64) + LEVELS // 2

    def count(self, p: np.ndarray, level: np.ndarray, gate: np.ndarray, bit: np.ndarray, weight: np.ndarray) -> None:
        """Count what followed each level of the mixed prediction."""
        gates = len(self.weights)
        at = gate * LEVELS + level
        self.refined[..., 0] += np.bincount(at, weight, gates * LEVELS).reshape(gates, LEVELS)
        self.refined[..., 1] += np.bincount(at, weight * bit, gates * LEVELS).reshape(gates, LEVELS)

    def learn(self, x: np.ndarray, gate: np.ndarray, bit: np.ndarray, weight: np.ndarray) -> None:
        """One online step over bits of the same place: predict, count, then correct the weights."""
        p, level = self.mix(x, gate)
        self.count(p, level, gate, bit, weight)
        gates = len(self.weights)
        miss = (bit - p) * weight
        seen = np.bincount(gate, weight, gates)
        self.learned += seen
        for i in range(self.weights.shape[1]):
            self.weights[:, i] += RATE * np.bincount(gate, miss * x[i], gates) / (seen + 1e-9)

    def fit(self, x: np.ndarray, gate: np.ndarray, bit: np.ndarray, weight: np.ndarray) -> None:
        """The weights under which all bits are likeliest, by Newton's method with halved steps, then the counts.

        A gate's weights are held by one bit's worth of a pull to where they start.
        """
        gates, n = self.weights.shape
        start = self.weights.copy()

        def loss(at: np.ndarray) -> np.ndarray:
            dot = np.einsum("ij,ji->i", at[gate], x)
            return np.bincount(gate, weight * np.logaddexp(0, np.where(bit == 1, -dot, dot)), gates) + ((at - start) ** 2).sum(1) / 2

        best = loss(self.weights)
        for _ in range(_ROUNDS):
            p = _squash(np.einsum("ij,ji->i", self.weights[gate], x))
            miss, bend = weight * (bit - p), weight * p * (1 - p)
            slope = np.stack([np.bincount(gate, miss * x[i], gates) for i in range(n)], axis=1) - (self.weights - start)
            curve = np.empty((gates, n, n))
            for i in range(n):
                for j in range(i + 1):
                    curve[:, i, j] = curve[:, j, i] = np.bincount(gate, bend * x[i] * x[j], gates)
            step = np.linalg.solve(curve + np.eye(n), slope[..., None])[..., 0]
            moved = False
            for _ in range(6):
                tried = self.weights + step
                found = loss(tried)
                better = found < best
                self.weights[better], moved = tried[better], moved or bool((best - found > 1e-9 * best).any())
                step = np.where(better[:, None], 0, step / 2)
                best = np.minimum(best, found)
                if not step.any():
                    break
            if not moved:
                break
        p, level = self.mix(x, gate)
        self.count(p, level, gate, bit, weight)
        self.learned += np.bincount(gate, weight, gates)

    def refine(self, p: np.ndarray, gate: np.ndarray, level: np.ndarray) -> np.ndarray:
        n, ones = self.refined[gate, level, 0], self.refined[gate, level, 1]
        return np.clip((p + (ones + 16 * p) / (n + 16)) / 2, 1e-7, 1 - 1e-7)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of ``_STRIDE`` and of its inverse, modulo 2^64."""
    global _KEPT
    if n > len(_KEPT[0]):
        powers = tuple(np.cumprod(np.r_[np.uint64(1), np.full(max(n, _RUN), f, dtype=np.uint64)], dtype=np.uint64) for f in (_STRIDE, _INVERSE))
        if n > _RUN:
            return powers
        _KEPT = powers
    return _KEPT


def hashes_of(words: pa.Array) -> np.ndarray:
    """64-bit hashes of all words at once: bytes weighed by powers of an odd number, mixed."""
    _, bounds, data = words.cast(pa.binary()).buffers()
    bounds = np.frombuffer(bounds, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data else np.zeros(0, dtype=np.uint8)
    bounds -= bounds[0]
    up, down = _powers(len(flat) + 1)
    total = np.zeros(len(flat) + 1, dtype=np.uint64)
    each = total[1:]
    each[:] = flat
    each += np.uint64(1)
    each *= up[: len(flat)]
    np.cumsum(each, out=each)
    # The weights start anew at each word.
    found = (total[bounds[1:]] - total[bounds[:-1]]) * down[bounds[:-1]] + _BEFORE
    for shift in (32, 29):
        found ^= found >> np.uint64(shift)
        found *= _MIX
    return found ^ (found >> np.uint64(32))


class Hashes(dict):
    """The hash of a word by itself."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = int(hashes_of(pa.array([word], pa.binary()))[0])
        return found


def class_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CLASS_BITS)).astype(np.int64)


def tokens_of(texts: list[bytes | None]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(tokens of all texts, lowered, with an empty one for each end; the text of each; where each text's tokens start)."""
    joined = b"".join([b"\n", *(part for t in texts for part in ((t or b"").lower(), b"\n"))])
    flat = np.frombuffer(joined, dtype=np.uint8)
    gap = _IS_GAP[flat]
    starts, ends = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1, np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    closed = np.cumsum(np.fromiter((len(t or b"") + 1 for t in texts), dtype=np.int64, count=len(texts)))
    # Words of the texts so far; with each text comes an end.
    upto = np.searchsorted(starts, closed) + np.arange(1, len(texts) + 1)
    sizes = np.diff(upto, prepend=0)
    lengths = np.zeros(len(starts) + len(texts), dtype=np.int32)
    words = np.ones(len(lengths), dtype=bool)
    words[upto - 1] = False
    lengths[words] = ends - starts
    bounds = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=bounds[1:])
    tokens = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(bounds), pa.py_buffer(flat[~gap])])
    return tokens, np.repeat(np.arange(len(texts)), sizes), upto - sizes


def runs(batch: pa.RecordBatch, text: int, size: int = _RUN) -> Iterator[pa.RecordBatch]:
    """Slices of about ``size`` bytes of text."""
    total = np.cumsum(np.nan_to_num(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False)).astype(np.int64) + 1)
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + size)))
        yield batch.slice(start, end - start)
        start = end


def token_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, hash of the token before, of the one before that) of every token, ends included."""
    tokens, _, firsts = tokens_of(texts)
    own = hashes_of(tokens)
    return own, *before(own, firsts)


def few(*columns: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """So many tokens at a time that what is made of them stays close to the processor."""
    for start in range(0, len(columns[0]), _FEW):
        yield tuple(c[start : start + _FEW] for c in columns)


def before(own: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the token before each and of the one before that; texts start at ``firsts``."""
    one, two = np.roll(own, 1), np.roll(own, 2)
    # A text of one token has the next text's first after it, which is set after it.
    two[firsts[firsts + 1 < len(own)] + 1] = _START
    one[firsts], two[firsts] = _START, _BEFORE
    return one, two


def class_contexts(one: np.ndarray, two: np.ndarray) -> list[np.ndarray]:
    first = (one + np.uint64(1)) * _MIX
    return [first, (first ^ (two * _STRIDE)) * _MIX]


def class_slots(contexts: list[np.ndarray], code: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The slots of bit ``k`` of the class in every context, and the bit."""
    node = (code >> (CLASS_BITS - k)) | (1 << k)
    salt = _SALTS[node]
    slots = [node]
    for order, context in enumerate(contexts, 1):
        x = context ^ salt
        x *= _MIX
        x >>= np.uint64(64 - CLASS_SLOT_BITS[order])
        at = x.view(np.int64)
        at += _CLASS_FIRST[order]
        slots.append(at)
    return slots, (code >> (CLASS_BITS - 1 - k)) & 1


def count_classes(tables: np.ndarray, own: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
    """Add the bits of tokens to ``tables`` (rows: zeros, ones)."""
    contexts, code, flat = class_contexts(one, two), class_of(own), tables.reshape(-1)
    codes = np.arange(1 << CLASS_BITS)
    in_code = np.bincount(code, minlength=len(codes)).astype(np.uint32)
    for k in range(CLASS_BITS):
        # Without context there are few slots: one addition for all tokens of a class.
        (node, *_), side = class_slots([], codes, k)
        np.add.at(flat, node + side * CLASS_SLOTS, in_code)
        (_, *slots), bit = class_slots(contexts, code, k)
        bit *= CLASS_SLOTS
        for at in slots:
            at += bit
            np.add.at(flat, at, np.uint32(1))


def _confidence(seen: np.ndarray) -> np.ndarray:
    return np.searchsorted([1.0, 4.0, 32.0], seen, side="right")


def with_confidence(logit: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Logits in 32 bits, the last two of which say how often the slot was seen: one look-up finds both."""
    return (logit.astype(np.float32).view(np.uint32) & np.uint32(0xFFFFFFFC)) | _confidence(seen).astype(np.uint32)


def taken_apart(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (found & np.uint32(0xFFFFFFFC)).view(np.float32), (found & np.uint32(3)).view(np.int32)


class Predictions:
    """What scoring needs of the class counts: each slot's prediction as a logit in half precision, and how often it was seen."""

    def __init__(self, tables: np.ndarray) -> None:
        slots = tables.shape[1]
        self.slots = np.empty(slots, dtype=np.uint32)
        # Piece by piece, as the driver has little room beside the tables.
        for at in range(0, slots, _CHUNK):
            zeros, ones = tables[:, at : at + _CHUNK].astype(np.float32)
            logit = np.log((ones + np.float32(0.4)) / (zeros + np.float32(0.4))).astype(np.float16)
            self.slots[at : at + _CHUNK] = with_confidence(logit, zeros + ones)


def without_own(tables: np.ndarray) -> np.ndarray:
    """By slot and bit: the prediction without one such bit, as its place in ``LOGITS`` and how often the slot was seen."""
    slots = tables.shape[1]
    codes = np.empty((slots, 2), dtype=np.uint8)
    between = (LOGITS[1:] + LOGITS[:-1]) / 2
    for at in range(0, slots, _CHUNK):
        for bit in (0, 1):
            zeros, ones = tables[:, at : at + _CHUNK].astype(np.float64)
            own = (zeros, ones)[bit]
            np.maximum(own - 1, 0, out=own)
            level = np.searchsorted(between, np.log((ones + 0.4) / (zeros + 0.4)))
            codes[at : at + _CHUNK, bit] = level * 4 + _confidence(zeros + ones)
    return codes.reshape(-1)


def class_scores(owner: np.ndarray, own: np.ndarray, one: np.ndarray, two: np.ndarray, texts: int, model: Predictions, mixer: Mixer) -> np.ndarray:
    """For each text the log10 probability of the classes of its tokens."""
    contexts, code = class_contexts(one, two), class_of(own)
    # A bit's refinement is linear in its mixed probability: slope and offset by gate and level.
    n, ones = mixer.refined[..., 0].ravel(), mixer.refined[..., 1].ravel()
    slope, offset = (0.5 + 8 / (n + 16)).astype(np.float32), (ones / (2 * (n + 16))).astype(np.float32)
    weights = np.ascontiguousarray(mixer.weights.T, dtype=np.float32)
    weights[CLASS_ORDERS] *= np.float32(0.3)
    node_logit = taken_apart(model.slots[: 1 << CLASS_BITS])[0]
    product = np.ones(len(own))
    for k in range(CLASS_BITS):
        slots, bit = class_slots(contexts, code, k)
        (x1, seen1), (x2, seen2) = (taken_apart(model.slots[at]) for at in slots[1:])
        gate = (seen1 * 4 + seen2 + k * 16).astype(np.int64)
        dot = weights[CLASS_ORDERS][gate]
        for i, x in enumerate((node_logit[slots[0]], x1, x2)):
            x *= weights[i][gate]
            dot += x
        level = np.clip(dot, -8, 8)
        level += level
        gate *= LEVELS
        gate += LEVELS // 2
        gate += np.rint(level, out=level).astype(np.int64)
        p = _squash(dot)
        p *= slope[gate]
        p += offset[gate]
        product *= np.clip(np.where(bit == 1, p, 1 - p), 1e-7, 1 - 1e-7)
    return np.bincount(owner, np.log10(product), texts)


def count_cells(cells: np.ndarray, codes: np.ndarray, own: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
    """Add the bits of tokens to their cells; ``codes`` are those of ``without_own``."""
    contexts, code = class_contexts(one, two), class_of(own)
    for k in range(CLASS_BITS):
        (node, *slots), bit = class_slots(contexts, code, k)
        cell = node
        for at in slots:
            at *= 2
            at += bit
            cell = cell << 8 | codes[at]
        np.add.at(cells, cell << 1 | bit, np.uint32(1))


def learn_classes(cells: np.ndarray, counts: np.ndarray, tables: np.ndarray) -> Mixer:
    """The mixer of the classes, from how many bits of all training tokens are in each cell."""
    bit, first, second, node = cells & 1, cells >> 9 & 255, cells >> 1 & 255, cells >> 17
    zeros, ones = (np.maximum(side[node].astype(np.float64) - (bit == own), 0) for own, side in enumerate(tables))
    x = np.stack([np.log((ones + 0.4) / (zeros + 0.4)), LOGITS[first >> 2], LOGITS[second >> 2], np.full(len(cells), 0.3)])
    mixer = Mixer(CLASS_GATES, CLASS_ORDERS)
    place = np.floor(np.log2(np.maximum(node, 1))).astype(np.int64)
    mixer.fit(x, place * 16 + (first & 3) * 4 + (second & 3), bit, counts.astype(np.float64))
    return mixer


def count_slots(batches: Iterator[tuple[list[bytes], np.ndarray]]) -> np.ndarray:
    """Counts of zeros and ones in every slot, as rows 0 and 1."""
    counts = np.zeros((2, SLOTS), dtype=np.uint32)
    flat = counts.reshape(-1)
    for words, weight in batches:
        owner, byte, contexts = spelled(words)
        each = weight[owner].astype(np.uint32)
        for k in range(8):
            slots, bit = slots_of(contexts, byte, k)
            slots += bit.astype(np.int64) * SLOTS
            for at in slots:
                np.add.at(flat, at, each)
    return counts


def spelling_without_own(counts: np.ndarray) -> np.ndarray:
    """By slot and bit: the prediction without one such bit as a logit, and how often the slot was seen."""
    found = np.empty((counts.shape[1], 2), dtype=np.uint32)
    for at in range(0, counts.shape[1], _CHUNK):
        for bit in (0, 1):
            zeros, ones = counts[:, at : at + _CHUNK].astype(np.float64)
            own = (zeros, ones)[bit]
            np.maximum(own - 1, 0, out=own)
            found[at : at + _CHUNK, bit] = with_confidence(np.log((ones + 0.2) / (zeros + 0.2)), zeros + ones)
    return found.reshape(-1)


def learn_mixer(batches: Iterator[tuple[list[bytes], np.ndarray]], predictions: np.ndarray) -> Mixer:
    """A mixer taught by the words; ``predictions`` are those of ``spelling_without_own``."""
    mixer = Mixer()
    for words, weight in batches:
        owner, byte, contexts = spelled(words)
        each = weight[owner]
        x = np.full((ORDERS + 1, len(byte)), 0.3)
        for k in range(8):
            slots, bit = slots_of(contexts, byte, k)
            slots *= 2
            slots += bit
            # The word's own occurrence must not predict itself.
            found = predictions[slots]
            x[:ORDERS] = (found & np.uint32(0xFFFFFFFC)).view(np.float32)
            mixer.learn(x, k * 4 + (found[-1] & np.uint32(3)).astype(np.int64), bit, each)
    return mixer


def word_scores(words: list[bytes], counts: np.ndarray, mixer: Mixer) -> np.ndarray:
    """The log10 probability of each word with its closing space."""
    found = []
    for some, _ in pieces(words, [0] * len(words)):
        owner, byte, contexts = spelled(some)
        total = np.zeros(len(byte))
        for k in range(8):
            slots, bit = slots_of(contexts, byte, k)
            x, gate = _inputs(counts[0][slots], counts[1][slots], k)
            p, level = mixer.mix(x, gate)
            p = mixer.refine(p, gate, level)
            total += np.log10(np.where(bit == 1, p, 1 - p))
        found.append(np.bincount(owner, total, len(some)))
    return np.concatenate(found) if found else np.zeros(0)


def _of_words(batches: Iterator[pa.RecordBatch], piece: int = _PIECE) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Training words (word, n) of a partition, in an order that hashing makes as good as random."""
    for batch in batches:
        rows = sorted(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), key=lambda r: xxhash.xxh64_intdigest(r[0]))
        yield from pieces([r[0] for r in rows], [r[1] for r in rows], piece)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): all distinct tokens of (doc_id, out, text), with how often they occur in training; the end is empty."""

    def count(batch):
        for run in runs(batch, 2, 4 * _RUN):
            tokens, owner, _ = tokens_of(run.column(2).to_pylist())
            found = tokens.dictionary_encode()
            train = ~run.column(1).to_numpy(zero_copy_only=False).astype(bool)
            n = np.bincount(found.indices.to_numpy(), train[owner], len(found.dictionary))
            yield {"word": found.dictionary, "n": pa.array(n.astype(np.int64))}

    return map_batches(docs, count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def packed(piece: np.ndarray) -> bytes:
    """Counts (rows: zeros, ones) as compressed bytes, with the few of 255 and more apart; most are small or none."""
    flat = piece.reshape(-1)
    large = np.flatnonzero(flat >= 255).astype("<u4")
    small = np.minimum(flat, 255).astype(np.uint8)
    data = b"".join([len(large).to_bytes(4, "little"), large.tobytes(), flat[large].astype("<u4").tobytes(), small.tobytes()])
    return len(data).to_bytes(4, "little") + pa.compress(data, "zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    data = pa.decompress(data[4:], int.from_bytes(data[:4], "little"), "zstd", asbytes=True)
    n = int.from_bytes(data[:4], "little")
    counts = np.frombuffer(data, np.uint8, offset=4 + 8 * n).astype(np.uint32)
    counts[np.frombuffer(data, "<u4", n, 4)] = np.frombuffer(data, "<u4", n, 4 + 4 * n)
    return counts.reshape(2, -1)


def _blobs(tables: np.ndarray, part: int) -> Iterator[dict]:
    """The non-empty pieces of ``tables`` (rows: zeros, ones)."""
    for at in range(0, tables.shape[1], _CHUNK):
        piece = tables[:, at : at + _CHUNK]
        if piece.any():
            yield {"chunk": at // _CHUNK, "part": part, "counts": packed(piece)}


_BLOB = "chunk int, part int, counts binary"


def _summed(blobs: DataFrame, parts: int, slots: int) -> np.ndarray:
    """The tables of all tasks added up, at most ``_FAN`` pieces at a time until one of each is left."""

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1, dtype=np.uint64)
        for c in group["counts"]:
            total = total + unpacked(c)
        # Counts beyond four bytes say no more about a bit.
        return group.iloc[:1].assign(counts=[packed(np.minimum(total, 0xFFFFFFFF).astype(np.uint32))])

    while parts > 1:
        parts = ceil(parts / _FAN)
        dealt = blobs.withColumn("part", F.pmod("part", F.lit(parts)).cast("int"))
        blobs = dealt.groupBy("chunk", "part").applyInPandas(merged, _BLOB)
    tables = np.zeros((2, slots), dtype=np.uint32)
    for r in blobs.select("chunk", "counts").toLocalIterator():
        tables[:, r.chunk * _CHUNK : (r.chunk + 1) * _CHUNK] = unpacked(r.counts)
    return tables


def _arrow(rows: list[dict]) -> pa.RecordBatch:
    names = {"chunk": pa.int32(), "part": pa.int32(), "counts": pa.binary()}
    return pa.RecordBatch.from_pydict({n: pa.array([r[n] for r in rows], t) for n, t in names.items()})


def fit_speller(vocab: DataFrame) -> tuple[np.ndarray, Mixer]:
    """Slot counts and mixer of the bytes of words, from the words (word, n) seen in training, each counted once."""
    seen = vocab.where("n > 0").select("word", F.lit(1).alias("n"))
    count = seen.count()
    parts = max(1, ceil(count / TASK_WORDS))
    # Spread by the words themselves, so that a repeated task counts the same ones.
    dealt = seen.repartition(parts, "word")

    def partial(batches):
        counts = count_slots(_of_words(batches))
        for row in _blobs(counts, TaskContext.get().partitionId()):
            yield _arrow([row])

    counts = _summed(dealt.mapInArrow(partial, _BLOB), parts, SLOTS)
    predictions = seen.sparkSession.sparkContext.broadcast(spelling_without_own(counts))

    def taught(batches):
        # All words of the part in an order of their own, so that it learns the same in whatever batches they come.
        words = sorted(chain.from_iterable(b.column(0).to_pylist() for b in batches), key=xxhash.xxh64_intdigest)
        found = learn_mixer(pieces(words, [1] * len(words), _STEP), predictions.value)
        values = np.concatenate([found.learned, (found.weights * found.learned[:, None]).ravel(), found.refined.ravel()])
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(len(values)), pa.int32()), "value": values})

    mixer = Mixer()
    sums = np.zeros(mixer.learned.size + mixer.weights.size + mixer.refined.size)
    for r in dealt.mapInArrow(taught, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():
        sums[r["at"]] = r.value
    predictions.destroy()
    mixer.learned, weights, refined = np.split(sums, np.cumsum([mixer.learned.size, mixer.weights.size]))
    any_bit = mixer.learned > 0
    mixer.weights[any_bit] = weights.reshape(mixer.weights.shape)[any_bit] / mixer.learned[any_bit, None]
    mixer.refined = refined.reshape(mixer.refined.shape)
    return counts, mixer


def fit_classes(slim: DataFrame) -> tuple[Predictions, Mixer]:
    """What the contexts over words predict, from the training rows of (doc_id, out, text)."""
    train = slim.where("NOT out").select("text")

    def tokens(batches):
        for batch in batches:
            for run in runs(batch, 0):
                yield from few(*token_hashes(run.column(0).to_pylist()))

    def partial(batches):
        tables = np.zeros((2, CLASS_SLOTS), dtype=np.uint32)
        for some in tokens(batches):
            count_classes(tables, *some)
        for row in _blobs(tables, TaskContext.get().partitionId()):
            yield _arrow([row])

    tables = _summed(train.mapInArrow(partial, _BLOB), max(1, train.rdd.getNumPartitions()), CLASS_SLOTS)
    codes = slim.sparkSession.sparkContext.broadcast(without_own(tables))

    def in_cells(batches):
        cells = np.zeros(CELLS, dtype=np.uint32)
        for some in tokens(batches):
            count_cells(cells, codes.value, *some)
        at = np.flatnonzero(cells)
        for start in range(0, len(at), _CHUNK):
            some = at[start : start + _CHUNK]
            yield pa.RecordBatch.from_pydict({"cell": pa.array(some, pa.int32()), "n": pa.array(cells[some], pa.int64())})

    # No more rows than cells, however large the input.
    found = train.mapInArrow(in_cells, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow().sort_by("cell")
    codes.destroy()
    cells, counts = (found.column(c).to_numpy().astype(np.int64) for c in ("cell", "n"))
    return Predictions(tables), learn_classes(cells, counts, tables)


def lm_scoring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The log10 probability of each text, learned from the texts that are not held out.

    Words are lowered (A-Z only) and cut at spaces and control characters 9 to
    13. Null texts count as empty; an empty text has the end as its only token.
    A null id is not held out. Rows that repeat both id and text are one
    document: they give one row, though each counts in training. An empty table
    gives an empty result; other columns are ignored. With nothing to learn
    from, all bits are even.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (by
    smoothed word frequencies), score (by the mixed model) and bits_per_byte
    (of the score, over the bytes of the text; null if it has none).
    """
    slim = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(held_out(id_col), F.lit(False)).alias("out"),
        F.col(text_col).cast("binary").alias("text"),
    )
    spark = docs.sparkSession
    vocab = cut(vocabulary(slim))
    totals = vocab.agg(
        F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("distinct"), F.count_if(F.col("n") == 1).alias("once")
    ).first()
    tokens, distinct = totals.n or 0, totals.distinct or 0
    # The share of tokens seen once estimates that of words not seen at all, which are spelled.
    spell = min(max(totals.once / tokens, 1e-4), 0.9) if tokens else 1.0
    below = log10(tokens + BASE_ALPHA * (distinct + 1))

    def by_class(batch):
        code = class_of(hashes_of(batch.column(0)))
        sums = np.bincount(code, batch.column(1).to_numpy(), 1 << CLASS_BITS)
        yield {"code": np.arange(1 << CLASS_BITS), "n": sums.astype(np.int64)}

    in_class = np.zeros(1 << CLASS_BITS)
    for r in map_batches(vocab.where("n > 0"), by_class, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        in_class[r.code] = r.n

    def known_share(batch):
        code = class_of(hashes_of(batch.column(0)))
        share = batch.column(1).to_numpy() / in_class[code]
        yield {"word": batch.column(0), "n": batch.column(1), "lm": pa.array(np.log10((1 - spell) * share))}

    # New words, spelled once each; the speller's tables are dropped before those of the classes are sent out.
    speller = spark.sparkContext.broadcast(fit_speller(vocab))

    def spelled_out(batch):
        lm = word_scores(batch.column(0).to_pylist(), *speller.value)
        # Spelling shares its mass among all classes, which the class's bits have told already.
        yield {"word": batch.column(0), "n": batch.column(1), "lm": pa.array(lm + log10(spell) + CLASS_BITS * log10(2))}

    kind = "word binary, n long, lm double"
    new = cut(map_batches(vocab.where("n = 0"), spelled_out, kind))
    speller.destroy()
    lexicon = map_batches(vocab.where("n > 0"), known_share, kind).unionByName(new)
    limit = tokens // FREQUENT
    often = lexicon.where((F.col("n") > limit) | (F.col("word") == F.lit(bytearray(_END))))
    classes = spark.sparkContext.broadcast(fit_classes(slim))
    often = [(bytes(r.word), r.n, r.lm) for r in often.toLocalIterator()]
    in_train = np.array([n for _, n, _ in often], dtype=np.float64)
    # After them a row of zeros, for all other words.
    table = np.zeros((3, len(often) + 1))
    table[:, :-1] = in_train > 0, np.log10(in_train + BASE_ALPHA) - below, [lm for *_, lm in often]
    frequent = spark.sparkContext.broadcast((pa.array([w for w, *_ in often], pa.binary()), table))

    facts = ("out", "n_tokens", "n_known", "base", "lm", "bytes")
    of_facts = pa.struct(zip(facts, (pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())))

    def looked_up(batch):
        (model, mixer), (words, table) = classes.value, frequent.value
        for run in runs(batch, 2):
            docs, outs, texts = run.column(0), run.column(1), run.column(2).to_pylist()
            n = len(texts)
            tokens, owner, firsts = tokens_of(texts)
            found = tokens.dictionary_encode()
            number, distinct = found.indices.to_numpy(), len(found.dictionary)
            place = pc.index_in(found.dictionary, value_set=words).fill_null(-1).to_numpy()
            known, base, lm = (np.bincount(owner, column[place][number], n) for column in table)
            own = hashes_of(found.dictionary)[number]
            for some in few(owner, own, *before(own, firsts)):
                lm += class_scores(*some, n, model, mixer)
            # A text's rare words, each once with how often it occurs, meet their facts in the join.
            rare = np.flatnonzero((place < 0)[number])
            pairs, tf = np.unique(owner[rare] * distinct + number[rare], return_counts=True)
            at, word = np.divmod(pairs, max(distinct, 1))
            keys = [xxhash.xxh64_intdigest(t or b"") - (1 << 63) for t in texts]
            # The document's own row meets no word: words hold no space.
            owns = pa.array([b" %d %d" % (doc or 0, key) for doc, key in zip(docs.to_pylist(), keys)], pa.binary())
            sizes = np.array([len(t or b"") for t in texts], dtype=np.int64)
            columns = outs, np.bincount(owner, minlength=n), known.astype(np.int64), base, lm, sizes
            own_facts = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, of_facts)], fields=list(of_facts))
            both = np.concatenate([at, np.arange(n)])
            # Of one item for a text, null for a word, which so takes next to no room.
            items = pa.array(np.concatenate([np.zeros(len(at), dtype=np.int64), np.arange(n + 1)]), pa.int32(), mask=np.arange(len(both) + 1) < len(at))
            yield {
                "doc_id": docs.take(pa.array(both)),
                "key": pa.array(np.array(keys, dtype=np.int64)[both]),
                "word": pa.concat_arrays([found.dictionary.take(pa.array(word)), owns]),
                "tf": pa.array(np.concatenate([tf, np.zeros(n, dtype=np.int64)]), pa.int32()),
                "facts": pa.ListArray.from_arrays(items, own_facts, type=pa.list_(pa.field("element", of_facts))),
            }

    rows = map_batches(
        slim,
        looked_up,
        "doc_id long, key long, word binary, tf int, "
        "facts array<struct<out:boolean,n_tokens:long,n_known:long,base:double,lm:double,bytes:long>>",
    )
    rare = lexicon.where((F.col("n") <= limit) & (F.col("word") != F.lit(bytearray(_END))))
    of_word = {
        "n_known": F.when(F.col("n") > 0, F.col("tf")).otherwise(0),
        "base": F.col("tf") * (F.log10(F.col("n") + BASE_ALPHA) - below),
        "lm": F.col("tf") * F.col("lm"),
    }
    # A partition's words fit in memory, however often they occur; sorting the rows would cost more than the join.
    met = rows.join(rare.hint("shuffle_hash"), "word", "left").select(
        "doc_id",
        "key",
        F.get("facts", F.lit(0))["out"].alias("out"),
        F.col("facts").isNotNull().cast("int").alias("own"),
        *[
            F.coalesce(F.get("facts", F.lit(0))[c], of_word.get(c, F.lit(0)), F.lit(0)).alias(c)
            for c in facts[1:]
        ],
    )
    sums = met.groupBy("doc_id", "key").agg(F.max("out").alias("out"), *[F.sum(c).alias(c) for c in ("own", *facts[1:])])
    each = lambda c: F.col(c) / F.col("own")  # noqa: E731  repeated rows are one document
    return sums.select(
        "doc_id",
        F.col("out").alias("held_out"),
        each("n_tokens").cast("long").alias("n_tokens"),
        each("n_known").cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        each("base").alias("base_score"),
        each("lm").alias("score"),
        F.when(F.col("bytes") > 0, -F.col("lm") * float(np.log2(10)) / F.col("bytes")).alias("bits_per_byte"),
    )
