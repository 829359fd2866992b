"""WARC archives: pages out, and whole payloads back from their segments.

Writing: a payload of ``LEAST_REVISIT`` bytes and more that an earlier page (by
id) has as well is a revisit record, which only names its digest; all others are
HTTP responses whose body is framed in chunks. A record longer than
``SEGMENT_BYTES`` is cut: the response holds segment 1, continuation records the
others, each with the origin's identifier and its number, the last with the
total length. Records are the rows of Spark's text writer, whose line separator
is the blank line that ends a record.

Reading: archives are read by Spark's text reader, cut where a record's version
line stands, so a file is a stream of records (and is split, if its compression
allows). Chunks are cut inside that mark wherever a payload holds it, so it
never stands in a block written here; in other archives a block that holds it
is put together again by its stated length. Continuation records are grouped by
origin and segment number first, so repeats of a hot origin fold before they
meet, then by origin, ordered, and checked against the total length; chunked
framing is decoded last. Revisits find their response by digest.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.llm.common import cut, join_counted, map_batches
from tidemark.sinks.storage import remove, shared_dir

LEAST_REVISIT = 100
SEGMENT_BYTES = 1 << 16
CHUNK_BYTES = 1 << 13
# The version line that starts a record, and what follows a block.
VERSION = b"WARC/1.1"
MARK, END = "WARC/1.1\r\n", "\r\n\r\n"
_DATE = "1970-01-01T00:00:00Z"
_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_REVISIT_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = (
    "type string, record_id string, page_id long, url string, digest string, origin string, segment int, "
    "total long, block binary, whole boolean"
)
PAGE = "page_id long, url string, type string, digest string, payload binary, whole boolean"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``payload`` in HTTP chunks of at most ``size`` bytes, none of which holds the version line."""
    cuts = set(range(0, len(payload), size)) | {m.end() - 1 for m in re.finditer(re.escape(VERSION), payload)}
    at = sorted(cuts | {len(payload)})
    parts = [b"%x\r\n%b\r\n" % (b - a, payload[a:b]) for a, b in zip(at, at[1:])]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked ``body``; None if its framing is broken or cut off. Extensions and trailers are passed over."""
    at, parts = 0, []
    while (end := body.find(b"\r\n", at)) >= 0:
        number = body[at:end].split(b";", 1)[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", number):
            return None
        size, at = int(number, 16), end + 2
        if not size:
            # The last chunk, then trailer lines, then an empty line.
            while (end := body.find(b"\r\n", at)) > at:
                at = end + 2
            return b"".join(parts) if end == at else None
        if body[at + size : at + size + 2] != b"\r\n":
            return None
        parts.append(body[at : at + size])
        at += size + 2
    return None


def http_payload(block: bytes) -> bytes | None:
    """The body of an HTTP response block, without transfer framing; None if it is broken."""
    head, blank, body = block.partition(b"\r\n\r\n")
    if not blank or not head.startswith(b"HTTP/"):
        return None
    encodings = [v for n, v in _fields(head) if n == "transfer-encoding"]
    return dechunked(body) if any("chunked" in v.lower() for v in encodings) else body


def _fields(head: bytes) -> Iterator[tuple[str, str]]:
    """(lower-case name, value) of the header lines after the first; folded lines belong to the line before."""
    for line in re.sub(rb"\r\n[ \t]+", b" ", head).split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            yield name.decode("utf-8", "replace").strip().lower(), value.decode("utf-8", "replace").strip()


def _uri(text: str) -> str:
    """``text`` with all but printable ASCII escaped; ``%`` too, so that it can be read back."""
    return "".join(c if "!" <= c <= "~" and c != "%" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in text)


def _from_uri(text: str) -> str:
    raw = re.sub(rb"%([0-9A-Fa-f]{2})", lambda m: bytes([int(m[1], 16)]), text.encode())
    return raw.decode("utf-8", "replace")


def _record(fields: dict[str, str | None], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in fields.items() if value is not None]
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""]).encode() + block


def records_of(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, segment_bytes: int) -> Iterator[bytes]:
    """The records of one page, each without the blank line that ends it."""
    origin = f"<urn:uuid:{uuid.uuid4()}>"
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": origin,
        "WARC-Date": _DATE,
        "WARC-Target-URI": None if url is None else _uri(url),
        "X-Page-Id": None if page_id is None else str(page_id),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if revisit:
        yield _record(fields | {"WARC-Profile": _PROFILE}, _REVISIT_HEAD)
        return
    block = _HEAD + chunked(payload)
    if len(block) <= segment_bytes:
        yield _record(fields, block)
        return
    for at in range(0, len(block), segment_bytes):
        number = {"WARC-Segment-Number": str(at // segment_bytes + 1)}
        if not at:
            yield _record(fields | number, block[:segment_bytes])
            continue
        last = at + segment_bytes >= len(block)
        yield _record(
            {
                "WARC-Type": "continuation",
                "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
                "WARC-Date": _DATE,
                "WARC-Target-URI": fields["WARC-Target-URI"],
                "WARC-Segment-Origin-ID": origin,
                **number,
                "WARC-Segment-Total-Length": str(len(block)) if last else None,
            },
            block[at : at + segment_bytes],
        )


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    segment_bytes: int = SEGMENT_BYTES,
    least_revisit: int = LEAST_REVISIT,
    compression: str = "gzip",
) -> None:
    """One record per page below ``path``, and continuations of the long ones.

    Null payloads are empty. Of pages with one payload of ``least_revisit``
    bytes and more, that with the smallest id is the response (all of them, if
    rows repeat id and payload; null ids come last), the others are revisits.
    Compression is per file, not per record.
    """
    slim = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    long_ones = F.octet_length("payload") >= least_revisit
    # Only payloads that occur more than once need their first page.
    copies = cut(
        slim.where(long_ones).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    )
    # Equal rows too are spread: by their place in the table, not by what they hold.
    row = F.xxhash64(F.monotonically_increasing_id())
    met = join_counted(slim, copies, ["digest"], "n", row, how="left")
    later = F.col("n").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    dealt = met.withColumn("revisit", later)

    def write(batch: pa.RecordBatch):
        found: list[bytes] = []
        for i in range(batch.num_rows):
            found += records_of(*(batch.column(c)[i].as_py() for c in range(5)), segment_bytes)
        yield {"record": found}

    lines = map_batches(dealt.select("page_id", "url", "payload", "digest", "revisit"), write, "record binary")
    lines.select(F.col("record").cast("string")).write.option("lineSep", END).option("compression", compression).text(path)


def parsed(piece: bytes) -> tuple[dict[str, str], bytes, bool] | None:
    """(fields, block, whether it is whole) of what follows a version line; None if there is no header."""
    head, blank, rest = piece.partition(b"\r\n\r\n")
    if not blank:
        return None
    fields = dict(_fields(b"\r\n" + head))
    length = fields.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", length):
        return fields, rest, False
    return fields, rest[: int(length)], len(rest) >= int(length)


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch("-?[0-9]{1,18}", text) else None


def _row(fields: dict[str, str], block: bytes, whole: bool) -> dict:
    digest = fields.get("warc-payload-digest", "")
    uri = fields.get("warc-target-uri")
    segment = _number(fields.get("warc-segment-number"))
    return {
        "type": fields.get("warc-type"),
        "record_id": fields.get("warc-record-id"),
        "page_id": _number(fields.get("x-page-id")),
        "url": None if uri is None else _from_uri(uri.strip("<>")),
        "digest": digest.removeprefix("sha256:") if digest.startswith("sha256:") else None,
        "origin": fields.get("warc-segment-origin-id"),
        "segment": segment if segment is None or 0 < segment < 1 << 31 else None,
        "total": _number(fields.get("warc-segment-total-length")),
        "block": block,
        "whole": whole,
    }


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives at ``path``, uncompressed or compressed as a whole or record by record.

    ``whole`` tells whether the block has its stated length. A block that holds
    the version line is read in pieces, which are joined within a task; where an
    uncompressed file is split just there, the record stays in pieces and is not
    whole. Pieces without a header are dropped.
    """
    lines = spark.read.option("lineSep", MARK).text(path).select(F.col("value").cast("binary").alias("piece"), "_metadata.file_path")
    kind = T.StructType.fromDDL(RECORD)
    names = kind.names

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(kind)
        held: tuple[str, bytes] | None = None

        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], f.type) for n, f in zip(names, arrow)], schema=arrow)

        for batch in batches:
            rows, size = [], 0
            for piece, file in zip(batch.column(0), batch.column(1)):
                piece, file = piece.as_py(), file.as_py()
                if held and held[0] == file:
                    piece = held[1] + MARK.encode() + piece
                elif held and (found := parsed(held[1])):
                    rows.append(_row(*found))
                held = None
                found = parsed(piece)
                if found and not found[2]:
                    held = file, piece
                elif found:
                    rows.append(_row(*found))
                    size += len(found[1])
                if size > 1 << 24:
                    yield out(rows)
                    rows, size = [], 0
            if rows:
                yield out(rows)
        if held and (found := parsed(held[1])):
            yield out([_row(*found)])

    return lines.mapInArrow(parse, RECORD)


def reassembled(records: DataFrame) -> DataFrame:
    """The records that are no continuations, with their whole block.

    Segments are grouped by the identifier of their first record and ordered by
    number. The block is whole if the numbers run from one without a gap, no two
    different blocks have one number, each is whole itself, and the last states
    the total length, which the blocks have together; otherwise ``whole`` is
    false and the block null. Continuations without their first record are
    dropped. Records that are not segmented are not shuffled.
    """
    continued = F.col("type") == "continuation"
    single = records.where(~F.coalesce(continued, F.lit(False)) & F.col("segment").isNull())
    parts = records.where(F.coalesce(continued, F.lit(False)) | F.col("segment").isNotNull()).select(
        F.when(continued, F.col("origin")).otherwise(F.col("record_id")).alias("key"),
        F.coalesce("segment", F.lit(1)).alias("segment"),
        F.when(~F.coalesce(continued, F.lit(False)), F.struct("type", "record_id", "page_id", "url", "digest")).alias("first"),
        "total",
        "block",
        "whole",
    )
    # Repeats of a segment fold here, with a map-side part; different blocks of one number show by their digests.
    once = (
        parts.where("key is not null")
        .withColumn("hash", F.sha2("block", 256))
        .groupBy("key", "segment")
        .agg(
            F.first("block", ignorenulls=True).alias("block"),
            (F.min("hash") == F.max("hash")).alias("same"),
            F.max("first").alias("first"),
            F.max("total").alias("total"),
            F.bool_and("whole").alias("whole"),
        )
    )
    segments = F.transform(F.array_sort("parts"), lambda p: p["block"])
    joined = (
        once.groupBy("key")
        .agg(
            F.max("first").alias("first"),
            F.max("total").alias("total"),
            F.max("segment").alias("last"),
            F.count("*").alias("n"),
            F.sum(F.octet_length("block").cast("long")).alias("size"),
            F.bool_and(F.col("same") & F.col("whole")).alias("sound"),
            F.collect_list(F.struct("segment", "block")).alias("parts"),
        )
        .where("first is not null")
        .withColumn("whole", F.coalesce(F.expr("sound AND n = last AND size = total"), F.lit(False)))
        .withColumn("block", F.when(F.col("whole"), F.aggregate(segments, F.lit(b""), lambda a, b: F.concat(a, b))))
    )
    kept = ["type", "record_id", "page_id", "url", "digest"]
    return single.select(*kept, "block", "whole").unionByName(
        joined.select(*[F.col("first")[c].alias(c) for c in kept], "block", "whole")
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Responses and revisits of the archives at ``path``, with decoded payloads (revisits: null).

    ``whole`` is false, and the payload null, where segments, lengths, framing
    or the stated digest do not fit.
    """

    def decode(batch: pa.RecordBatch):
        out = {n: [] for n in ("payload", "whole")}
        for kind, digest, block, whole in zip(*(batch.column(i).to_pylist() for i in range(3, 7))):
            payload = http_payload(block) if whole and kind == "response" else None
            fits = payload is not None and digest in (None, hashlib.sha256(payload).hexdigest())
            out["payload"].append(payload if fits else None)
            out["whole"].append(fits if kind == "response" else bool(whole))
        names = ("page_id", "url", "type", "digest")
        yield {n: batch.column(batch.schema.get_field_index(n)) for n in names} | out

    rows = reassembled(read_records(spark, path)).where("type in ('response', 'revisit')")
    return map_batches(rows.select("page_id", "url", "record_id", "type", "digest", "block", "whole"), decode, PAGE)


def warc_round_trip(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    segment_bytes: int = SEGMENT_BYTES,
    least_revisit: int = LEAST_REVISIT,
) -> DataFrame:
    """What reading finds of each page in archives written from ``pages``; the archives are removed.

    Rows may repeat; each gives a record and a row. An empty table gives an
    empty result; other columns are ignored. A revisit whose response is not in
    the archives has no payload size.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to, and
    url as read back.
    """
    spark = pages.sparkSession
    path = shared_dir(spark, "warc")
    write_archives(pages, path, id_col, url_col, payload_col, segment_bytes, least_revisit)
    # Payloads end here: what is kept of them is size and digest.
    found = cut(
        read_pages(spark, path).select(
            "page_id",
            "url",
            "type",
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.when(F.col("type") == "revisit", F.col("digest")).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        )
    )
    remove(spark, path)
    responses, revisits = found.where("type = 'response'"), found.where("type = 'revisit'")
    named = ["page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type")]
    origins = (
        responses.where("payload_digest is not null")
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("refers_to"), F.max("payload_bytes").alias("payload_bytes"))
    )
    wanted = revisits.groupBy("payload_digest").agg(F.count("*").alias("n"))
    met = cut(wanted.join(origins, "payload_digest", "left"))
    resolved = join_counted(revisits.drop("payload_bytes"), met, ["payload_digest"], "n", F.xxhash64(F.monotonically_increasing_id()))
    return responses.select(*named, F.lit(None).cast("long").alias("refers_to"), "url").unionByName(
        resolved.select(*named, "refers_to", "url")
    )
