"""Reading of stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_table(spark: SparkSession, source: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A table by path or catalogue name.

    Pass ``schema`` for partitioned paths: left alone, Spark reads a text
    partition column such as ``dtRef`` back as a date, and puts it last.
    """
    if "/" not in source:
        return spark.table(source)
    if schema is None:
        return spark.read.parquet(source)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return spark.read.schema(schema).parquet(source).select(*schema.names)


def read_partition(
    spark: SparkSession, source: str, col: str, value: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """One partition; only its directory is listed and read."""
    return read_table(spark, source, schema).where(F.col(col) == F.lit(value))
