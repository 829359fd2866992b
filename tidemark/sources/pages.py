"""Landing pages, each file one JSON array of records, read record by record.

A JSON reader that takes a page as a whole loses all its records to one that does
not fit. Here a page is parsed to a VARIANT, exploded, and every record is cast
to the schema by itself: those that do not fit are returned beside the others.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_PIECES = "file string, pos int, text string, whole boolean"
UNREADABLE, UNFIT, UNKEYED = "unreadable", "does not fit", "no key"


def page_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, page): one row per file. Pages are small: the crawl limits their records."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("page"))


def _salvaged(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records before the place where a page breaks off, and what follows them as one unreadable text."""
    decoder = json.JSONDecoder()
    for batch in texts:
        out: dict[str, list] = {"file": [], "pos": [], "text": [], "whole": []}
        for file, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            at = len(page) - len(page.lstrip(" \t\r\n﻿"))
            pos, many = 0, page[at : at + 1] == "["
            at += many
            while many:
                at += len(page[at:]) - len(page[at:].lstrip(" \t\r\n,"))
                try:
                    _, end = decoder.raw_decode(page, at)
                except (ValueError, RecursionError):
                    break
                for value, to in zip((file, pos, page[at:end], True), out.values()):
                    to.append(value)
                pos, at = pos + 1, end
            for value, to in zip((file, pos, page[at:], False), out.values()):
                to.append(value)
        yield pa.RecordBatch.from_pydict(
            {"file": pa.array(out["file"], pa.string()), "pos": pa.array(out["pos"], pa.int32()), "text": pa.array(out["text"], pa.string()), "whole": out["whole"]}
        )


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, value, text): every record of every page as a VARIANT, or, if unreadable, its text.

    A page may also be a single record. Of a page that does not parse, the
    records before the break are saved by a second reading of that page alone.
    Empty files and empty arrays hold no record.
    """
    parsed = page_texts(spark, path).where(F.col("page").rlike(r"\S")).withColumn("v", F.expr("try_parse_json(page)"))
    is_array = F.expr("schema_of_variant(v) LIKE 'ARRAY<%'")
    whole = parsed.where(F.col("v").isNotNull())
    as_array = whole.withColumn("e", F.when(is_array, F.expr("try_variant_get(v, '$', 'array<variant>')")).otherwise(F.array("v")))
    sound = as_array.select("file", F.posexplode("e").alias("pos", "value"), F.lit(None).cast("string").alias("text"))
    broken = parsed.where(F.col("v").isNull()).select("file", "page").mapInArrow(_salvaged, _PIECES)
    value = F.when(F.col("whole"), F.expr("try_parse_json(text)"))
    saved = broken.withColumn("value", value).select(
        "file", "pos", "value", F.when(F.col("value").isNull(), F.col("text")).alias("text")
    )
    return sound.unionByName(saved)


def _path(name: str) -> str:
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return f"$['{quoted}']"


def _field(field: T.StructField, kind: str | None = None) -> Column:
    literal = _path(field.name).replace("\\", "\\\\").replace("'", "\\'")
    return F.expr(f"try_variant_get(value, '{literal}', '{kind or field.dataType.simpleString()}')")


def _lost(cast: Column, raw: Column) -> Column:
    return cast.isNull() & raw.isNotNull() & ~F.call_function("is_variant_null", raw)


def cast_records(records: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(records that fit the schema, as its columns; the others as file, pos, reason and text).

    A field that a record lacks, or that is null there, is NULL. A field, or an
    element of an array, that holds something its type cannot hold makes the
    record unfit, and so does a record that is no object. Fields beyond the
    schema are left out; below a struct, what does not fit is NULL.
    """
    raw = {i: "array<variant>" if isinstance(f.dataType, T.ArrayType) else "variant" for i, f in enumerate(schema.fields)}
    checked = records.withColumns(
        {f"_f{i}": _field(field) for i, field in enumerate(schema.fields)}
        | {f"_r{i}": _field(field, "variant") for i, field in enumerate(schema.fields)}
        | {f"_a{i}": _field(schema[i], kind) for i, kind in raw.items() if kind != "variant"}
    )
    lost = [_lost(F.col(f"_f{i}"), F.col(f"_r{i}")) for i in raw]
    lost += [
        F.exists(F.arrays_zip(F.col(f"_f{i}").alias("f"), F.col(f"_a{i}").alias("a")), lambda z: _lost(z["f"], z["a"]))
        for i, kind in raw.items() if kind != "variant"
    ]
    is_object = F.expr("schema_of_variant(value) LIKE 'OBJECT<%'")
    reason = F.when(F.col("value").isNull(), UNREADABLE)
    unfit = ~is_object
    for one in lost:
        unfit = unfit | F.coalesce(one, F.lit(False))
    checked = checked.withColumn("_reason", reason.when(unfit, UNFIT))
    good = checked.where("_reason IS NULL").select(*[F.col(f"_f{i}").alias(f.name) for i, f in enumerate(schema.fields)])
    bad = checked.where("_reason IS NOT NULL").select(
        "file", "pos", F.col("_reason").alias("reason"), F.coalesce("text", F.to_json("value")).alias("record")
    )
    return good, bad


def read_pages(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of the pages at ``path``; without ``schema``, that of ``infer_pages``."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema or infer_pages(spark, path)
    return cast_records(page_records(spark, path), kind)


def infer_pages(spark: SparkSession, path: str) -> T.StructType:
    """The merged schema of all records, by one aggregation with a map-side part.

    Numbers with a fraction are doubles; fields of several kinds, or only null, are texts.
    """
    found = page_records(spark, path).where("value IS NOT NULL AND schema_of_variant(value) LIKE 'OBJECT<%'")
    text = found.agg(F.expr("schema_of_variant_agg(value)").alias("s")).first().s
    if not text or not text.startswith("OBJECT<"):
        return T.StructType([])
    return _plain(T.StructType.fromDDL(f"r {text.replace('OBJECT<', 'STRUCT<')}")[0].dataType)


def _plain(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    if isinstance(kind, (T.DecimalType, T.FloatType)):
        return T.DoubleType()
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType)) else kind
