"""Incremental reads by a stored high-water mark: each run opens only files that came since the last."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.sinks.storage import exists, read_text, write_text
from tidemark.sources.landing import read_landing

_MODIFIED = "_metadata.file_modification_time"


def load_mark(spark: SparkSession, file: str) -> dt.datetime | None:
    """The time up to which files were read, None before the first run."""
    if not exists(spark, file):
        return None
    return dt.datetime.fromisoformat(json.loads(read_text(spark, file))["modified"])


def save_mark(spark: SparkSession, file: str, modified: dt.datetime) -> None:
    write_text(spark, file, json.dumps({"modified": modified.isoformat()}))


def extract_since_mark(
    spark: SparkSession,
    path: str,
    mark: str,
    fmt: str = "json",
    schema: T.StructType | str | None = None,
    overlap: dt.timedelta = dt.timedelta(0),
    **options: str,
) -> tuple[DataFrame, Callable[[], dt.datetime | None]]:
    """(rows of the files modified after the mark, a function that moves the mark once they are applied).

    The mark is a file of its own, one per endpoint. The filter is on the files'
    modification time, so older files are left out when the scan is planned and
    never opened. ``overlap`` reads files again that are so much older than the
    mark, for stores whose listings or clocks lag; an upsert takes the repeated
    rows. If a run dies before it moves the mark, the next one reads the same
    files. The mark moves to the latest file these rows were planned with, and
    files that came meanwhile are left to the next run.
    """
    before = load_mark(spark, mark)
    rows = read_landing(spark, path, fmt, schema, **options)
    latest = rows.select(F.max(_MODIFIED).alias("m"))
    if before is not None:
        since = F.lit(before - overlap)
        latest = rows.where(F.col(_MODIFIED) > since).select(F.max(_MODIFIED).alias("m"))
        rows = rows.where(F.col(_MODIFIED) > since)
    # With a zone, as the mark must mean the same to a session in another one.
    found = latest.select(F.unix_micros("m").alias("us")).first().us
    if found is None:
        return rows.limit(0), lambda: before
    upto = dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(microseconds=found)
    rows = rows.where(F.col(_MODIFIED) <= F.lit(upto))

    def move() -> dt.datetime | None:
        moved = max(upto, before) if before else upto
        save_mark(spark, mark, moved)
        return moved

    return rows, move
