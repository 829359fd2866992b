"""Upserts whose newest rows are kept in the state store until a watermark passes them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.sinks.keyed_table import KeyedTable
from tidemark.streaming.upserts import FOLD_ABOVE, applier

_SLOT, _BEST, _TIME = "_slot", "_best", "_time"


def newest_in_state(stream: DataFrame, ids: Sequence[str], ts: str, tie: Sequence[str], delay: str, slot: str) -> DataFrame:
    """The newest row per key and slot of event time, as a streaming aggregation for update mode.

    Each task ships one row per key and slot. The state of a slot is dropped
    once the latest ``ts`` seen is ``delay`` past the slot's end, and rows that
    come for it later are dropped: the state holds keys of the open slots only,
    however long the stream runs. A NULL ``ts`` has no slot and fails the batch.
    """
    # Watermarks want an instant. Date-times without a zone count as UTC, whatever the session's zone.
    instant = F.col(ts)
    if stream.schema[ts].dataType.typeName() == "timestamp_ntz":
        instant = F.expr(f"TIMESTAMP '1970-01-01 00:00:00Z' + (`{ts}` - TIMESTAMP_NTZ '1970-01-01 00:00:00')")
    timed = F.coalesce(instant, F.raise_error(F.lit(f"a row without {ts}")).cast("timestamp"))
    rest = [c for c in stream.columns if c not in ids]
    best = F.max_by(F.struct(*rest), F.struct(ts, *tie)).alias(_BEST)
    groups = stream.withColumn(_TIME, timed).withWatermark(_TIME, delay).groupBy(*ids, F.window(_TIME, slot).alias(_SLOT))
    return groups.agg(best).select(*[c if c in ids else F.col(_BEST)[c].alias(c) for c in stream.columns])


def upsert_in_state(
    stream: DataFrame, table: KeyedTable, checkpoint: str, delay: str, slot: str = "1 day", above: float = FOLD_ABOVE
) -> int:
    """Upsert what the stream has now into ``table`` through the state of ``newest_in_state``; how much came too late.

    A batch writes only the newest rows of the keys and slots it touched, and a
    row that an earlier batch has beaten within its slot is not written again.
    State and watermark live in the checkpoint, so the next run goes on with
    them. Late rows never reach the table; the number returned is Spark's count
    of them after the map-side part, one for each task, key and slot. A table
    with a rejects folder reads each batch twice, which a state must not be, and
    is refused; rows without a key fail the batch.
    """
    if table.rejects is not None:
        raise ValueError("a table with a rejects folder cannot be fed from the state store")
    if table.mode != "newest":
        raise ValueError("the state keeps the newest rows: the table's mode must be newest")
    table.ensure()
    apply, late, query = applier(table), {}, None

    def count_late() -> None:
        # Spark keeps the last progresses only, so they are read batch by batch.
        for progress in query.recentProgress if query else ():
            late[progress.batchId] = sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)

    def on_batch(batch: DataFrame, number: int) -> None:
        apply(batch, number)
        count_late()

    newest = newest_in_state(stream.select(*table.schema.names), table.ids, table.ts, table.tie, delay, slot)
    query = (
        newest.writeStream.foreachBatch(on_batch)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    count_late()
    table.compact(above)
    return sum(late.values())
