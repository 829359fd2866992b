"""Landing directory as a stream, run to exhaustion into a keyed table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.sinks.keyed_table import KeyedTable
from tidemark.sources.landing import landing_options

# Changes are folded into the base once they hold over this share of its bytes: folding writes all of it.
FOLD_ABOVE = 0.25


def stream_landing(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json", **options: str
) -> DataFrame:
    """The directory as an unbounded file source; a stream needs its schema declared."""
    return spark.readStream.format(fmt).options(**landing_options(fmt, options)).schema(schema).load(path)


def run_available(
    stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process all files that are there now, then stop.

    The checkpoint remembers them, so a later run sees new files only.
    """
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def checkpoint_for(landing: str, name: str) -> str:
    """Checkpoint directory of a landing directory: a sibling, never inside it."""
    return f"{landing.rstrip('/')}_{name}_checkpoint"


def upsert_stream(
    stream: DataFrame, table: KeyedTable, checkpoint: str, compact: bool = True, above: float = FOLD_ABOVE
) -> StreamingQuery:
    """Upsert the stream's batches into ``table``, then fold them into its base once they outgrow ``above`` times it.

    A batch replayed after a failure carries the same query id and batch number,
    hence the same token, and overwrites its first attempt.
    """
    table.ensure()
    query = run_available(stream, applier(table), checkpoint)
    if compact:
        table.compact(above)
    return query


def applier(table: KeyedTable) -> Callable[[DataFrame, int], None]:
    def on_batch(batch: DataFrame, number: int) -> None:
        query_id = table.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        table.apply(batch, f"{query_id}.{number}")

    return on_batch
