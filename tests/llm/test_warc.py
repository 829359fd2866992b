import gzip
import hashlib

import pytest

from tidemark.llm import warc
from tidemark.llm.warc import chunked, dechunked, read_pages, read_records, warc_round_trip, write_archives

SCHEMA = "page_id long, url string, html string, digest string, payload string, type string, n long, block int, revisit string, key string"
LONG = "".join(f"<p>line {i} of a long page</p>\r\n" for i in range(9000))
ROWS = [
    (5, "http://a.com/x", "<html>" + "same " * 50),
    (3, "http://b.com/x", "<html>" + "same " * 50),
    (9, None, "<html>" + "same " * 50),
    (None, "http://c.com/", "<html>" + "same " * 50),
    (1, "http://a.com/short", "short"),
    (2, "http://a.com/short2", "short"),
    (4, "", None),
    (6, "http://a.com/empty", ""),
    (7, "http://é.com/ü?q=a b%20c\r\nX: y", "été " * 40 + "\U0001f600" * 30),
    (8, "http://w.com/", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 400),
    (10, "http://w.com/2", "x" * 8185 + "WARC/1.1" + "\r\n\r\n0\r\n\r\n" * 9 + "WARC/1.1"),
    (11, "http://l.com/", LONG),
    (12, "http://l.com/2", LONG),
    (13, "http://z.com/", "z" * 400_000),
    (14, "http://z.com/", "WARC/1.1\r\n" * 30_000),
    (15, "http://z.com/", "\r\n" * 200),
    (16, "u" * 100_000, "y" * 100),
    (17, "u", "y" * 99),
    (18, "u", "y" * 99),
    (19, "u", "repeated row " * 20),
    (19, "u", "repeated row " * 20),
    (20, "u", "repeated row " * 20),
]


def _frame(spark, rows):
    return spark.createDataFrame([(*r, *"dpt", 1, 2, "r", "k") for r in rows], SCHEMA).repartition(3)


def _plain(rows):
    first: dict = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, url, html in rows:
        body = (html or "").encode()
        later = len(body) >= 100 and html in first and i != first[html]
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if later else "response", first[html] if later else None, url))
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment_bytes", [512, 5000, 1 << 16, 1 << 30])
def test_round_trip(spark, segment_bytes):
    found = sorted([tuple(r) for r in warc_round_trip(_frame(spark, ROWS), segment_bytes=segment_bytes).collect()], key=repr)
    assert found == _plain(ROWS)


def test_empty_and_only_copies(spark):
    assert warc_round_trip(spark.createDataFrame([], SCHEMA)).collect() == []
    many = [(i, "u", "one page that many hold " * 10) for i in range(700)]
    found = sorted([tuple(r) for r in warc_round_trip(_frame(spark, many)).collect()], key=repr)
    assert found == _plain(many)


@pytest.mark.parametrize("size", [1, 3, 1000])
@pytest.mark.parametrize("payload", [b"", b"a", b"WARC/1.1\r\n" * 5, b"0\r\n\r\n" * 7, b"xWARC/1.1", bytes(range(256)) * 3])
def test_chunks(payload, size):
    framed = chunked(payload, size)
    assert dechunked(framed) == payload and b"WARC/1.1" not in framed
    # With extensions, upper-case sizes and trailers, as other writers leave them.
    assert dechunked(b"A;x=y\r\n0123456789\r\n0\r\nTrailer: 1\r\n\r\n") == b"0123456789"
    assert dechunked(framed[:-1]) is None and dechunked(b"zz\r\n" + framed) is None
    assert dechunked(b"5\r\nabc\r\n0\r\n\r\n") is None


def _record(kind, number, body, origin=None, total=None, extra=""):
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:r:{origin or number}{kind}{number}>\r\nX-Page-Id: 1\r\n{extra}"
    if origin:
        head += f"WARC-Segment-Number: {number}\r\n"
        head += f"WARC-Segment-Origin-ID: {origin}\r\n" if kind == "continuation" else ""
    if total is not None:
        head += f"WARC-Segment-Total-Length: {total}\r\n"
    return f"{head}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def _segments(cuts=(0, 40, 90), total=None, name="s"):
    block = b"HTTP/1.1 200 OK\r\ntransfer-encoding: chunked\r\n\r\n" + chunked(b"the payload of many segments " * 4, 16)
    parts = [block[a:b] for a, b in zip(cuts, [*cuts[1:], len(block)])]
    origin = f"<urn:r:{name}response1>"
    first = _record("response", 1, parts[0], origin=name)
    rest = [
        _record("continuation", i + 2, p, origin=origin, total=(total or len(block)) if i == len(parts) - 2 else None) for i, p in enumerate(parts[1:])
    ]
    return [first, *rest], b"the payload of many segments " * 4


def _read(spark, tmp_path, *files):
    for i, data in enumerate(files):
        (tmp_path / f"part-{i}.warc{'.gz' if data[:2] == b'\x1f\x8b' else ''}").write_bytes(data)
    return read_pages(spark, str(tmp_path)).collect()


def test_segments_from_several_files_in_any_order(spark, tmp_path):
    (a, b, c), payload = _segments()
    found = _read(spark, tmp_path, c + a, b + a, b * 50)
    assert [(r.payload, r.whole) for r in found] == [(payload, True)]


def test_damage_is_told(spark, tmp_path):
    (a, b, c), _ = _segments()
    (d, e, f), _ = _segments(total=7, name="t")
    (g, h, i), _ = _segments(name="v")
    other = h.replace(b"payload", b"PAYLOAD")
    (_, k, m), _ = _segments(name="w")
    cut_off = _record("response", 1, b"HTTP/1.1 200 OK\r\n\r\nabc")[:-9]
    wrong = _record("response", 2, b"HTTP/1.1 200 OK\r\n\r\nabc", extra=f"WARC-Payload-Digest: sha256:{'0' * 64}\r\n")
    found = _read(spark, tmp_path, a + c, d + e + f, g + h + other + i, k + m, wrong + cut_off)
    # A gap, a wrong total, two blocks of one number, no first record, a wrong digest, an end too early.
    assert len(found) == 5 and all(r.payload is None and not r.whole for r in found)


def test_foreign_archives(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\n\r\n" + b"a WARC/1.1\r\nWARC-Type: response\r\n\r\nb " * 20
    record = _record("response", 1, body, extra="Folded: a\r\n  b\r\n")
    info = _record("warcinfo", 1, b"software: x\r\n")
    packed = gzip.compress(info) + gzip.compress(record) + gzip.compress(record)
    found = _read(spark, tmp_path, info + record, packed, b"", b"not an archive")
    assert len(found) == 3 and all(r.whole and r.payload == body[19:] for r in found)
    records = read_records(spark, str(tmp_path))
    assert sorted(r.type for r in records.collect()) == ["response"] * 3 + ["warcinfo"] * 2


def test_archives_are_kept_where_asked(spark, tmp_path):
    path = str(tmp_path / "archives")
    write_archives(_frame(spark, ROWS), path, segment_bytes=1000, compression="none")
    texts = b"".join(p.read_bytes() for p in (tmp_path / "archives").glob("part-*"))
    assert texts.startswith(b"WARC/1.1\r\n") and texts.endswith(b"\r\n\r\n")
    kinds = {r.type: r.n for r in read_records(spark, path).groupBy("type").count().withColumnRenamed("count", "n").collect()}
    assert sum(kinds.values()) == texts.count(b"WARC/1.1\r\n") and kinds["response"] + kinds["revisit"] == len(ROWS)
    assert kinds["continuation"] > 100 and kinds["revisit"] == sum(r[3] == "revisit" for r in _plain(ROWS))
    assert warc.VERSION == b"WARC/1.1"
