"""Distinct counts from bitmaps of items, which merge over days and windows by OR.

Items are long ids. A bitmap is one long that holds the ids of one bucket of 64
consecutive ids; one per entity, time slot, bucket and flag is built with a
map-side part. So a row has the same few bytes however far apart an entity's
ids lie, and there are never more rows than distinct pairs of entity (and slot)
and item. Bitmaps of any slots are OR-ed, so an item counts once however
often it is credited, listed or covered by overlapping windows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

ALL = "_all"
BUCKET = "_bucket"
BITS = 64
# Bitmap columns are told from other numbers by this mark, which Spark keeps with a column.
_MARK = {"bitmap": True}


def item_bitmaps(facts: DataFrame, entity: str, item: str, flags: Mapping[str, str], slots: Sequence[str] = ()) -> DataFrame:
    """(entity, slots, ``_bucket``, a bitmap of all items and one per flag) from credit rows.

    ``flags`` maps names to SQL predicates; a NULL predicate is false. Rows
    without an item keep their entity, with empty bitmaps in bucket NULL.
    """
    bit = f"shiftleft(1L, cast(pmod(cast(`{item}` AS BIGINT), {BITS}) AS INT))"

    def bitmap(name: str, predicate: str = "true") -> Column:
        word = F.expr(f"bit_or(CASE WHEN `{item}` IS NOT NULL AND ({predicate}) THEN {bit} ELSE 0L END)")
        return word.alias(name, metadata=_MARK)

    bucket = F.shiftright(F.col(item).cast("long"), BITS.bit_length() - 1)
    # The bucket is computed beside the columns that predicates read.
    keyed = facts.withColumn(BUCKET, bucket).groupBy(entity, *slots, BUCKET)
    return keyed.agg(bitmap(ALL), *[bitmap(name, p) for name, p in flags.items()])


def merged_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of the same keys and bucket OR-ed into one."""
    names = [f.name for f in bitmaps.schema.fields if f.metadata.get("bitmap")]
    return bitmaps.groupBy(*keys, BUCKET).agg(*[F.bit_or(F.col(f"`{n}`")).alias(n, metadata=_MARK) for n in names])


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str], names: Mapping[str, str], share: bool = False) -> DataFrame:
    """Distinct items per key for each bitmap (``names``: bitmap to output), or their share of all items."""
    merged = merged_bitmaps(bitmaps, keys)
    sums = merged.groupBy(*keys).agg(*[F.expr(f"sum(bit_count(`{n}`)) AS `{n}`") for n in dict.fromkeys([ALL, *names])])
    form = f"try_divide(`{{}}`, `{ALL}`) AS `{{}}`" if share else "`{}` AS `{}`"
    return sums.select(*keys, *[F.expr(form.format(n, out)) for n, out in names.items()])
