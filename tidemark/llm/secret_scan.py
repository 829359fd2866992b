"""Secret scanning: a keyword automaton first, anchored expressions near its hits, checksums last.

An Aho-Corasick automaton runs over the lowered text (A-Z only, so positions
stay) and finds the few places where a secret can start. Only there is an
expression tried, anchored at the hit. Runs of hex digits have no keyword; they
get an automaton of their own over the text with every hex digit mapped to one
sign, whose only word is a run of 16. Tokens that embed a checksum are added
only if it holds: GitHub and npm tokens end in the CRC-32 of their body in base
62. Hits are taken from left to right and those inside a former match of the
kind are skipped, which gives the matches of scanning the whole text.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import ahocorasick
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import map_batches

MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 12, 18, 16

# Keywords, kinds and the order in which spans of one start are listed.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = ("assign", "access", "hex")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_CHECKED = re.compile(r"(gh[pousr]_|npm_)([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_HEX_SIGN = "\x01"


def checksum62(body: str) -> str:
    """CRC-32 of ``body`` as six digits in base 62."""
    n, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        digits = BASE62[d] + digits
    return digits


def _automaton(words) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for w in words:
        found.add_word(w, w)
    found.make_automaton()
    return found


class Scanner:
    """Both automata; built once for each task, as they cannot be sent to it cheaply."""

    def __init__(self) -> None:
        self.words = _automaton((*ASSIGN_WORDS, "akia", *CHECKED_PREFIXES))
        self.runs = _automaton([_HEX_SIGN * MIN_HEX])
        self.hex_bytes = bytes.maketrans(b"\x010123456789abcdef", b" " + b"\x01" * 16)

    def scan(self, text: str | None) -> list[tuple[int, int, str]]:
        """(start, end, kind) in code points, by start, then kind as listed."""
        if not text:
            return []
        raw = text.encode("utf-8", "surrogatepass")
        lowered = raw.lower().decode("utf-8", "surrogatepass")
        spans, past = [], dict.fromkeys(KINDS, 0)
        # A hit is reported at its end; order by start, as matches are taken.
        hits = sorted((end - len(word) + 1, word) for end, word in self.words.iter(lowered))
        for start, word in hits:
            if word in ASSIGN_WORDS:
                m = start >= past["assign"] and _ASSIGN.match(text, start)
                if m:
                    past["assign"] = m.end()
                    if len(m[2]) >= MIN_ASSIGNED:
                        spans.append((start, m.end(), "assign"))
            elif word == "akia":
                m = start >= past["access"] and _ACCESS.match(text, start)
                if m:
                    past["access"] = m.end()
                    if m.end() - start >= MIN_ACCESS:
                        spans.append((start, m.end(), "access"))
            else:
                kind = "npm" if word == "npm_" else "github"
                m = start >= past[kind] and _CHECKED.match(text, start)
                if m and checksum62(m[2]) == m[3]:
                    past[kind] = m.end()
                    spans.append((start, m.end(), kind))
        mapped = raw.translate(self.hex_bytes).decode("utf-8", "surrogatepass")
        for end, _ in self.runs.iter(mapped):
            start = end - MIN_HEX + 1
            if start >= past["hex"]:  # the first hit in a run starts where the run does
                m = _HEX.match(text, start)
                past["hex"] = m.end()
                spans.append((start, m.end(), "hex"))
        return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def _listed(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The secrets in each document.

    Kinds ``assign``, ``access`` and ``hex`` go by form and length; ``github``
    and ``npm`` only with a valid checksum. Null counts as empty; empty texts
    have no spans. Repeated rows and null ids give a row each, an empty table an
    empty result; other columns are ignored.

    Returns doc_id, n_assign, n_access, n_hex, base_sha256 (of the first three
    kinds' spans) and spans (all, as kind:start:end, comma-joined).
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scanners: list[Scanner] = []

    def scan(batch):
        if not scanners:
            scanners.append(Scanner())
        found = [scanners[0].scan(t) for t in batch.column(1).to_pylist()]
        base = [[s for s in spans if s[2] in BASE_KINDS] for spans in found]
        yield {
            "doc_id": batch.column(0),
            **{f"n_{k}": [sum(s[2] == k for s in spans) for spans in base] for k in BASE_KINDS},
            "base_sha256": [hashlib.sha256(_listed(spans).encode()).hexdigest() for spans in base],
            "spans": [_listed(spans) for spans in found],
        }

    return map_batches(
        slim, scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )
