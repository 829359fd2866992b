"""Upsert of one keyed DataFrame into another, as a pure function."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.dedup import latest_per_key, split_null_keys

MODES = ("last_write", "newest")


def upsert(
    target: DataFrame,
    source: DataFrame,
    ids: Sequence[str],
    mode: str = "last_write",
    ts: str | None = None,
    null_keys: str = "drop",
) -> DataFrame:
    """Rows of ``target`` with ``source`` merged in, in the target's columns.

    ``source`` must hold one row per key (see ``latest_per_key``).
    ``last_write`` always takes the source row; ``newest`` keeps a target row
    whose ``ts`` is greater. NULL never matches NULL: source rows with a NULL in
    the key are dropped, or inserted again with ``null_keys="append"``.

    ``last_write`` joins on unique keys, which cannot skew, and Spark broadcasts
    the source by itself when its measured size allows: then the target is not
    shuffled at all. ``newest`` reads and shuffles each side once.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if null_keys not in ("drop", "append"):
        raise ValueError("null_keys must be 'drop' or 'append'")
    ids = list(ids)
    keyed, unkeyed = split_null_keys(target, ids)
    incoming, loose = split_null_keys(source.select(*target.columns), ids)
    if mode == "newest":
        if ts is None:
            raise ValueError("mode 'newest' needs ts")
        # One pass over both: the later row wins, and of equal times the incoming one.
        side = "_side"
        while side in target.columns:
            side += "_"
        both = keyed.withColumn(side, F.lit(0)).unionByName(incoming.withColumn(side, F.lit(1)))
        latest = latest_per_key(both, ids, [ts, side]).select(*target.columns).unionByName(unkeyed)
        return latest.unionByName(loose) if null_keys == "append" else latest
    merged = (
        keyed.join(incoming.select(*ids), ids, "left_anti")
        .select(*target.columns)
        .unionByName(incoming.select(*target.columns))
        .unionByName(unkeyed)
    )
    return merged.unionByName(loose) if null_keys == "append" else merged
