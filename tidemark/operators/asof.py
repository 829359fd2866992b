"""Point-in-time lookups: entity spines and the as-of join."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T, Window as W

# Time is cut into 2**SLICE_BITS slices of about equal row count.
SLICE_BITS = 10
QUANTILE_ACCURACY = 4 << SLICE_BITS
# A group of so many rows, or of 1/2**SLICE_BITS of all, is scanned by one task.
HOT_ROWS = 1_000_000
_SKETCH_ITEMS = 8192


def spine(ids: DataFrame, dates: Column, name: str = "event_timestamp") -> DataFrame:
    """Every row of ``ids`` for every date of an array column (no join needed)."""
    return ids.select("*", F.explode(dates.cast("array<timestamp_ntz>")).alias(name))


def _common_time(spine_type: T.DataType, ref_type: T.DataType) -> str:
    kinds = (spine_type, ref_type)
    return "timestamp" if any(isinstance(k, T.TimestampType) for k in kinds) else "timestamp_ntz"


def _quantiles(times: DataFrame, bits: int) -> Column:
    """Scalar subquery: the ``2**bits - 1`` quantiles of ``_t``, and for each its first index.

    One pass with a mergeable sketch; nothing is collected.
    """
    count = 1 << bits
    cuts = ", ".join(f"{i / count!r}D" for i in range(1, count))
    sketch = times.agg(F.expr(f"percentile_approx(_t, array({cuts}), {QUANTILE_ACCURACY})").alias("at"))
    return sketch.selectExpr("struct(at, transform(at, t -> array_position(at, t) - 1) AS first) AS q").scalar()


def _parked(slice_: str) -> str:
    """SQL for the slice; rows without id or time, which match nothing, are spread by hash instead."""
    return f"if(_id IS NULL OR _t IS NULL, -1 - (xxhash64(_row) & {(1 << SLICE_BITS) - 1}), {slice_})"


def _with_slice(df: DataFrame, quantiles: Column, bits: int) -> DataFrame:
    """Add ``_slice``, which grows with ``_t`` and holds about ``1/2**bits`` of the rows.

    It is the number of quantiles at or before ``_t``, found by binary search. An
    instant so frequent that several quantiles fall on it owns several slices:
    rows looking something up are hashed over them, feature rows take the first,
    where the rest inherit them. Rows without id or time match nothing and are
    parked, by hash, in slices below all others.
    """
    steps, found = [], "0"
    for bit in reversed(range(bits)):
        edge = f"get(_q.at, {found} + {(1 << bit) - 1})"
        steps.append(f"{found} + if({edge} <= _t, {1 << bit}, 0) AS _s{bit}")
        found = f"_s{bit}"
    owned = f"if(get(_q.at, {found} - 1) = _t, {found} - get(_q.first, {found} - 1), 0)"
    spread = f"{found} - if(_owned > 1, if(_side = 1, pmod(xxhash64(_row), _owned), _owned - 1), 0)"
    return (
        df.withColumn("_q", quantiles)
        .selectExpr("*", *steps, f"{owned} AS _owned")
        .selectExpr(*df.columns, f"bigint({_parked(spread)}) AS _slice")
    )


def _carried(both: DataFrame) -> DataFrame:
    """What each (id, slice) inherits: the last feature row of the slices before, if any."""
    summary = both.groupBy("_id", "_slice").agg(
        F.max_by("_feat", F.when(F.col("_side") == 0, F.col("_t"))).alias("_feat"),
        F.max("_side").alias("_wanted"),
    )
    earlier = W.partitionBy("_id").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    return (
        summary.withColumn("_feat", F.last("_feat", ignorenulls=True).over(earlier))
        .where((F.col("_wanted") == 1) & F.col("_feat").isNotNull())
        .select("_id", "_slice", "_feat", F.lit(-1).alias("_side"))
    )


def _micros(time: str, kind: str) -> str:
    """SQL for microseconds since 1970: elapsed ones, or by the wall clock for times without zone."""
    if kind == "timestamp":
        return f"unix_micros({time})"
    return f"bigint(1000000 * cast({time} - TIMESTAMP_NTZ '1970-01-01' AS DECIMAL(20, 6)))"


def _buckets(both: DataFrame, max_age: dt.timedelta, kind: str) -> DataFrame:
    """Rows in the bucket of ``max_age`` that they lie in, features in theirs and in the next one.

    A feature row that a row may use is less than one bucket older, so both meet.
    """
    width = max(max_age // dt.timedelta(microseconds=1), 1)
    bucket = f"(_us - pmod(_us, {width}L)) div {width}L"
    own = both.withColumn("_us", F.expr(_micros("_t", kind)))
    copies = F.expr(f"if(_side = 0, array({bucket}, {bucket} + 1), array({_parked(bucket)}))")
    return own.withColumn("_slice", F.explode(copies)).drop("_us")


def _within_reach(left: DataFrame, right: DataFrame, max_age: dt.timedelta, kind: str = "timestamp_ntz") -> DataFrame:
    """Feature rows that are not too old for the first row, nor too young for the last."""
    span = left.agg(F.min("_t").alias("low"), F.max("_t").alias("high"))
    # Spark takes days from a time with zone by the calendar, where a day may have 25 hours.
    room = dt.timedelta(days=1 if kind == "timestamp" else 0)
    oldest = span.select(F.col("low") - F.lit(max_age + room)).scalar()
    return right.where((F.col("_t") >= oldest) & (F.col("_t") <= span.select("high").scalar()))


def _has_hot_group(both: DataFrame, group: Sequence[str]) -> bool:
    """Whether one group may hold more rows than a task should scan.

    Small inputs need a count only; of others a mergeable sketch estimates the
    largest group, and what it may have missed counts as hot.
    """
    rows = both.count()
    if rows <= HOT_ROWS:
        return False
    # It lists no group at all where the largest is too small to stand out, far below the share that counts as hot.
    top = F.get(F.expr(f"approx_top_k(key, 1, {_SKETCH_ITEMS})"), F.lit(0))["count"]
    largest = both.select(F.xxhash64(*group).alias("key")).agg(F.coalesce(top, F.lit(0)).alias("n")).first().n
    return largest > max(HOT_ROWS, rows >> SLICE_BITS)


def asof_join(
    rows: DataFrame,
    feats: DataFrame,
    id: str,
    ts: str,
    ref: str,
    max_age: dt.timedelta | None = None,
    tie: Sequence[str] = (),
    slice_bits: int | None = None,
) -> DataFrame:
    """For each row the feature row of its ``id`` with the greatest ``ref <= ts``.

    All rows stay; without a match the feature columns (and ``ref``) are NULL.
    ``max_age`` drops matches that are older. ``tie`` decides equal ``ref``.

    No pairs are formed: groups are scanned in time order. A group is an id; with
    ``max_age`` it is an id and a bucket of that length, feature rows being copied
    to the next bucket too, and those out of reach of all rows are left out before.
    Where one group could hold too much for a task (measured beforehand; hand in
    stored tables), time is cut at quantiles instead: (id, slice) groups are
    scanned, and what a slice needs from before it is one carried row per
    (id, slice), found from per-slice summaries. So the largest group is the share
    of one slice. ``slice_bits`` forces that (0: forces scans of whole groups).
    """
    overlap = set(rows.columns) & (set(feats.columns) - {id})
    if overlap:
        raise ValueError(f"both sides have columns {sorted(overlap)}")
    kind = _common_time(rows.schema[ts].dataType, feats.schema[ref].dataType)
    payload = [c for c in feats.columns if c != id]

    left = rows.select(
        F.col(id).alias("_id"), F.col(ts).cast(kind).alias("_t"), F.struct(*rows.columns).alias("_row")
    )
    right = feats.select(
        F.col(id).alias("_id"), F.col(ref).cast(kind).alias("_t"), F.struct(*payload).alias("_feat")
    ).where(F.col("_id").isNotNull() & F.col("_t").isNotNull())
    if max_age is not None:
        right = _within_reach(left, right, max_age, kind)

    def stacked(features: DataFrame) -> DataFrame:
        return left.withColumn("_side", F.lit(1)).unionByName(features.withColumn("_side", F.lit(0)), allowMissingColumns=True)

    def grouped(both: DataFrame) -> DataFrame:
        if max_age is not None:
            return _buckets(both, max_age, kind)
        return both.withColumn("_slice", F.expr(_parked("0L")))

    if slice_bits is None:
        keys = grouped(stacked(right).select("_id", "_t", "_side", "_row").where("_id IS NOT NULL AND _t IS NOT NULL"))
        slice_bits = SLICE_BITS if _has_hot_group(keys, ["_id", "_slice"]) else 0
    order = [F.col("_t").asc_nulls_first(), F.col("_side")]
    if slice_bits:
        # Equal times of one id: keep the feature row that the tie columns choose.
        once = right
        if tie:
            once = right.groupBy("_id", "_t").agg(
                F.max_by("_feat", F.struct(*[F.col("_feat")[c] for c in tie])).alias("_feat")
            )
        quantiles = _quantiles(left.select("_t").unionByName(right.select("_t")), slice_bits)
        both = _with_slice(stacked(once), quantiles, slice_bits)
        both = both.unionByName(_carried(both), allowMissingColumns=True)
    else:
        # The scan meets equal times in the order of the tie columns, so the greatest comes last.
        both = grouped(stacked(right))
        order += [F.col("_feat")[c] for c in tie]
    within = (
        W.partitionBy("_id", "_slice")
        .orderBy(*order)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    matched = (
        both.withColumn("_feat", F.last("_feat", ignorenulls=True).over(within))
        .where(F.col("_side") == 1)
        .select("_row", "_feat")
    )
    feat = F.col("_feat")
    if max_age is not None:
        times = {"_new": F.col("_row")[ts].cast(kind), "_old": feat[ref].cast(kind)}
        age = F.expr(f"{_micros('_new', kind)} - {_micros('_old', kind)}")
        young = age <= max_age // dt.timedelta(microseconds=1)
        matched = matched.withColumns(times).withColumn("_feat", F.when(young, feat))
    return matched.select("_row.*", *[F.col("_feat")[c].alias(c) for c in payload])
