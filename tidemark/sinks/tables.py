"""Writing of whole tables and of single partitions.

Every replacement is first written beside what it replaces and swapped in only
when it is complete: a query that fails leaves the old rows where they were,
and a table may be computed from itself.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.functions.dates import DateRange
from tidemark.sinks.storage import exists, is_empty, remove, shared_dir, staging, swap_in


def save_full(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table at a path, or of a catalogue name, schema included.

    Unpartitioned output keeps the plan's own partitions. Partitioned output is
    rebalanced on the partition columns, so that each partition gets few, evenly
    sized files and a large one is still split over several tasks.
    """
    spark = df.sparkSession

    def even(rows: DataFrame) -> DataFrame:
        return rows.hint("rebalance", *partition_by) if partition_by else rows

    if "/" in target:
        staged = staging(target)
        even(df).write.partitionBy(*partition_by).parquet(staged)
        swap_in(spark, staged, target)
        return
    # The catalogue drops the old table first, so the rows are computed before that.
    staged = shared_dir(spark, "table")
    df.write.parquet(staged)
    even(spark.read.schema(df.schema).parquet(staged)).write.mode("overwrite").partitionBy(*partition_by).saveAsTable(target)
    remove(spark, staged)


def ensure_table(
    spark: SparkSession, target: str, schema: T.StructType | str, partition_by: Sequence[str] = ()
) -> None:
    """Create an empty table if nothing is stored there; never touches what is."""
    found = not is_empty(spark, target) if "/" in target else spark.catalog.tableExists(target)
    if not found:
        save_full(spark.createDataFrame([], schema), target, partition_by)


def _partition_path(path: str, col: str, value: str) -> str:
    if not re.fullmatch(r"[\w.\-]+", value):
        raise ValueError(f"partition value {value!r} would need escaping")
    return f"{path}/{col}={value}"


def _only(df: DataFrame, part_col: str, belongs: Column, what: str) -> DataFrame:
    foreign = F.raise_error(
        F.concat(F.lit(f"row outside {what}: "), F.coalesce(F.col(part_col).cast("string"), F.lit("NULL")))
    )
    return df.where(F.when(belongs, True).otherwise(foreign.cast("boolean")))


def replace_partition(df: DataFrame, path: str, part_col: str, value: str) -> None:
    """Replace exactly the rows with ``part_col = value``.

    An empty result leaves an empty partition. A row of another partition fails
    the job before anything is replaced.
    """
    target = _partition_path(path, part_col, value)
    checked = _only(df, part_col, F.col(part_col).cast("string") == value, f"partition {value}")
    staged = staging(target)
    checked.drop(part_col).write.parquet(staged)
    swap_in(df.sparkSession, staged, target)


def write_backfill(df: DataFrame, path: str, dates: DateRange, part_col: str = "dtRef") -> None:
    """Replace the partitions of all dates of the range in one job.

    Partitions outside the range stay, and a row dated there fails the job
    before anything is replaced. Dates without any row are noticed while writing
    and their old partitions emptied, as overwriting alone would keep them.
    """
    seen, day, labels = Observation(), F.col(part_col).cast("string"), list(dates.labels())
    (
        _only(df, part_col, day.isin(labels), f"the dates {labels[0]} to {labels[-1]}")
        .observe(seen, F.collect_set(day).alias("dates"))
        .hint("rebalance", part_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(part_col)
        .parquet(path)
    )
    written = set(seen.get["dates"])
    spark = df.sparkSession
    for date in labels:
        if date not in written and exists(spark, _partition_path(path, part_col, date)):
            replace_partition(spark.createDataFrame([], df.schema), path, part_col, date)
