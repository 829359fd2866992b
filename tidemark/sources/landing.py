"""Batch reading of landing directories (one directory per endpoint)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.sinks.storage import exists, read_text, write_text

# A page is one JSON array over several lines.
LANDING_OPTIONS = {"json": {"multiLine": "true"}}


def landing_options(fmt: str, options: dict[str, str]) -> dict[str, str]:
    return {**LANDING_OPTIONS.get(fmt, {}), **options}


def read_landing(
    spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType | str | None = None, **options: str
) -> DataFrame:
    """Scan a landing directory. Without ``schema`` Spark infers it by a full read."""
    reader = spark.read.format(fmt).options(**landing_options(fmt, options))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def resolve_schema(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    declared: T.StructType | str | None = None,
    **options: str,
) -> T.StructType:
    """The declared schema (struct, DDL text, or a saved schema file) or the inferred one."""
    if isinstance(declared, T.StructType):
        return declared
    if declared is not None:
        if declared.endswith(".json"):
            saved = load_schema(spark, declared)
            if saved is not None:
                return saved
        else:
            return T.StructType.fromDDL(declared)
    return read_landing(spark, path, fmt, **options).schema


def save_schema(spark: SparkSession, schema: T.StructType, file: str) -> None:
    """Freeze a schema in a JSON file, on any file system that Spark reaches."""
    write_text(spark, file, json.dumps(schema.jsonValue(), indent=2))


def load_schema(spark: SparkSession, file: str) -> T.StructType | None:
    """The schema of a file, None if there is none."""
    return T.StructType.fromJson(json.loads(read_text(spark, file))) if exists(spark, file) else None


CORRUPT = "_corrupt_record"


def read_accounted(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json", **options: str
) -> tuple[DataFrame, DataFrame]:
    """(rows that were read, records or pages that could not be: what could be read of them, file and raw text).

    Records that do not parse would otherwise come back as rows of NULLs, or not
    at all. Keep the second table, and repair and load its files again.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if CORRUPT in kind.names:
        raise ValueError(f"the column name {CORRUPT} is taken")
    kind = T.StructType([*kind.fields, T.StructField(CORRUPT, T.StringType())])
    rows = read_landing(
        spark, path, fmt, kind, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **options
    ).withColumn("_file", F.input_file_name())
    bad = rows.where(F.col(CORRUPT).isNotNull())
    # Spark refuses to read the raw text of a file alone, hence the other columns.
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file"), bad.withColumnsRenamed(
        {"_file": "file", CORRUPT: "record"}
    )


def incremental_extract(df: DataFrame, ts_col: str, cutoff: Column) -> DataFrame:
    """Rows changed at or after ``cutoff``; the bare column lets the filter reach the scan."""
    return df.where(F.col(ts_col) >= cutoff)
