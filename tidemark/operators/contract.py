"""Export contract for feature tables: which types leave, and as what."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

_EXPORT = {
    T.IntegerType: "bigint",
    T.LongType: "bigint",
    T.StringType: "string",
    T.FloatType: "float",
    T.DoubleType: "float",
    T.TimestampType: "timestamp",
}


def feature_projection(df: DataFrame) -> DataFrame:
    """Cast to the export types; any other type is an error, before any job runs."""
    out = []
    for field in df.schema.fields:
        target = _EXPORT.get(type(field.dataType))
        if target is None:
            raise ValueError(f"column {field.name!r} has no export type: {field.dataType.simpleString()}")
        out.append(F.col(field.name).cast(target).alias(field.name))
    return df.select(*out)
