"""Point-in-time features per entity, for one reference date or many at once.

Every set is computed in the same three steps:

1. credit rows -> one row per (entity, item): row count and OR-ed flags, so
   distinct counts become plain sums and need no ``Expand``; for a window, credit
   rows of items outside it are dropped before, by a filter of the items' ids;
2. join with the item side, which carries the release day, the measures and,
   for tag sets, the flags of all the item's tags: tags are folded per item
   before any entity is involved, so they never multiply the credit rows;
3. sum per entity. A backfill sums per (entity, window, first date, last date)
   first and only then spreads those few sums over the dates they count for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.functions.columns import day_bound, pack_flags, unpack_flag
from tidemark.functions.dates import DateRange
from tidemark.operators.semijoin import reduced, shares
from tidemark.operators.shape import trailing
from tidemark.operators.skew import heavy_keys, salted_join
from tidemark.plans import feature_spec as fs
from tidemark.plans.feature_spec import FeatureSpec


def _words(predicates: list[str]) -> dict[str, Column]:
    return {f"_w{i}": word for i, word in enumerate(pack_flags(predicates))}


def entity_items(facts: DataFrame, entity: str, item: str, predicates: list[str] = ()) -> DataFrame:
    """One row per (entity, item): ``_n`` rows and the OR of the flags of those rows."""
    words = _words(list(predicates))
    return (
        facts.where(F.col(item).isNotNull())
        .select(entity, item, *[w.alias(name) for name, w in words.items()])
        .groupBy(entity, item)
        .agg(F.count("*").alias("_n"), *[F.bit_or(name).alias(name) for name in words])
    )


def attach_items(facts: DataFrame, items: DataFrame, item: str) -> DataFrame:
    """Credit rows with their item's columns; ``items`` is unique per ``item``.

    An outer join followed by a filter on the item side keeps matches only, so
    this is an inner join. The rows of a hot item are spread by a hash of all
    their other columns.
    """
    spread = [c for c in facts.columns if c != item]
    return salted_join(facts, items, item, spread, heavy_keys(facts, item))


def _fill_untagged(df: DataFrame, dim: DataFrame, predicates: list[str]) -> DataFrame:
    """Give rows without flag words those of a tag whose columns are all NULL."""
    absent = {f.name: F.lit(None).cast(f.dataType) for f in dim.schema.fields if f.name not in df.columns}
    words = {name: F.coalesce(F.col(name), word) for name, word in _words(predicates).items()}
    return df.withColumns(absent).withColumns(words).drop(*absent)


def tag_rows(bridge: DataFrame, dim: DataFrame, item: str, tag: str, predicates: list[str]) -> DataFrame:
    """The bridge with the packed flags of each row's tag.

    The predicates are tested once per row of the dimension, so the bridge joins
    a number, not the dimension's texts. A tag the dimension lacks is a NULL tag.
    """
    words = _words(predicates)
    flags = dim.select(tag, *[w.alias(name) for name, w in words.items()])
    tagged = bridge.where(F.col(item).isNotNull()).select(item, tag).join(flags, tag, "left").drop(tag)
    return _fill_untagged(tagged, dim, predicates)


def attach_tags(
    items: DataFrame, bridge: DataFrame, dim: DataFrame, item: str, tag: str, predicates: list[str]
) -> DataFrame:
    """``items`` plus the packed tag flags; an item without tags counts as one NULL tag.

    Items and tagged rows are stacked and folded per item: one shuffle with a
    map-side part does the work of an aggregation, two sorts and an outer join.
    """
    shared = (set(dim.columns) - {tag}) & set(items.columns)
    if shared:
        raise ValueError(f"items and tag dimension share columns {sorted(shared)}")
    words = list(_words(predicates))
    carried = [c for c in items.columns if c != item]
    tagged = tag_rows(bridge, dim, item, tag, predicates)
    folded = (
        items.withColumn("_item", F.lit(True))
        .unionByName(tagged, allowMissingColumns=True)
        .groupBy(item)
        .agg(
            F.bool_or("_item").alias("_item"),
            *[F.max(name).alias(name) for name in carried],
            *[F.bit_or(name).alias(name) for name in words],
        )
        .where("_item")
        .drop("_item")
    )
    return _fill_untagged(folded, dim, predicates)


def flag_counts(facts: DataFrame, entity: str, item: str, flags: dict[str, str]) -> DataFrame:
    """Distinct items per entity for which each predicate holds on some row."""
    return _flag_totals(facts, entity, item, flags, share=False)


def flag_shares(facts: DataFrame, entity: str, item: str, flags: dict[str, str]) -> DataFrame:
    """The same as a share of the entity's distinct items (NULL if it has none)."""
    return _flag_totals(facts, entity, item, flags, share=True)


def _flag_totals(facts: DataFrame, entity: str, item: str, flags: dict[str, str], share: bool) -> DataFrame:
    predicates = list(dict.fromkeys(flags.values()))
    words = _words(predicates)
    # Rows with a NULL item keep their entity in the result but count for nothing.
    per_item = (
        facts.select(entity, item, *[w.alias(name) for name, w in words.items()])
        .groupBy(entity, item)
        .agg(*[F.bit_or(name).alias(name) for name in words])
        .withColumn("_known", F.col(item).isNotNull())
    )
    sums = per_item.groupBy(entity).agg(
        F.count_if("_known").alias("_items"),
        *[
            F.expr(f"coalesce(sum({unpack_flag('_w', i)}) FILTER (WHERE _known), 0L) AS _f{i}")
            for i in range(len(predicates))
        ],
    )
    form = "try_divide({}, _items)" if share else "{}"
    return sums.select(
        entity, *[F.expr(form.format(f"_f{predicates.index(p)}")).alias(name) for name, p in flags.items()]
    )


def _partials(spec: FeatureSpec) -> dict[str, tuple[str, str]]:
    """Additive parts per (entity, item) row: SQL to make each, function to merge it."""
    parts = {
        "_items": ("count(1)", "sum"),
        "_first": ("min(_day)", "min"),
        "_last": ("max(_day)", "max"),
    }
    for i in range(len(spec.predicates)):
        parts[f"_f{i}"] = (f"sum({unpack_flag('_w', i)})", "sum")
    for i in range(len(spec.measures)):
        # Averages and sums run over credit rows: weight each item by its rows.
        parts[f"_s{i}"] = (f"sum(_m{i} * _n)", "sum")
        parts[f"_c{i}"] = (f"sum(_n) FILTER (WHERE _m{i} IS NOT NULL)", "sum")
    return parts


def _outputs(spec: FeatureSpec, day: str) -> list[Column]:
    """The output columns from the merged parts; ``day`` is SQL for the reference date."""
    flags, measures = spec.predicates, spec.measures
    out = []
    for feature in spec.features:
        if feature.kind == fs.ITEMS:
            sql = "_items"
        elif feature.kind == fs.FLAG_COUNT:
            sql = f"_f{flags.index(feature.arg)}"
        elif feature.kind == fs.FLAG_SHARE:
            sql = f"_f{flags.index(feature.arg)} / _items"
        elif feature.kind == fs.DAYS_FIRST:
            sql = f"datediff({day}, _first)"
        elif feature.kind == fs.DAYS_LAST:
            sql = f"datediff({day}, _last)"
        elif feature.kind == fs.AVG0:
            i = measures.index(feature.arg)
            sql = f"coalesce(try_divide(_s{i}, _c{i}), 0D)"
        else:
            sql = f"coalesce(_s{measures.index(feature.arg)}, 0L)"
        out.append(F.expr(sql).alias(feature.name))
    return out


def _item_side(items: DataFrame, spec: FeatureSpec, tags: tuple[DataFrame, DataFrame] | None) -> DataFrame:
    side = items.select(
        spec.item,
        F.col(spec.release).cast("date").alias("_day"),
        *[F.col(name).alias(f"_m{i}") for i, name in enumerate(spec.measures)],
    )
    if spec.tag is None:
        return side
    if tags is None:
        raise ValueError(f"{spec.name} needs a tag bridge and dimension")
    bridge, dim = tags
    return attach_tags(side, bridge, dim, spec.item, spec.tag, spec.predicates)


def _windowed_facts(facts: DataFrame, items: DataFrame, window: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Credit rows of the items in the window, and perhaps a few others: what is worth folding."""
    slim = facts.select(*dict.fromkeys([spec.entity, spec.item, *_flag_columns(facts, spec)]))
    return reduced(slim, window.select(spec.item), spec.item, shares(window, items))


def _flag_columns(facts: DataFrame, spec: FeatureSpec) -> list[str]:
    """The columns that a fold of the credit rows may read besides its keys."""
    return [] if spec.tag else [c for c in facts.columns if any(c.lower() in p.lower() for p in spec.predicates)]


def _credited(facts: DataFrame, side: DataFrame, spec: FeatureSpec) -> DataFrame:
    pairs = entity_items(facts, spec.entity, spec.item, [] if spec.tag else spec.predicates)
    return salted_join(pairs, side, spec.item, [spec.entity], heavy_keys(facts, spec.item))


def build_features(
    facts: DataFrame,
    items: DataFrame,
    spec: FeatureSpec,
    date: str,
    tags: tuple[DataFrame, DataFrame] | None = None,
    sort: bool = False,
) -> DataFrame:
    """The feature set as of ``date``: one row per entity with an item in the window.

    ``items`` must be unique per item; ``tags`` is (bridge, dimension). ``sort``
    orders the result by entity.
    """
    window = trailing(items, spec.release, date, spec.months)
    if spec.months is not None:
        facts = _windowed_facts(facts, items, window, spec)
    side = _item_side(window, spec, tags)
    parts = _partials(spec)
    sums = _credited(facts, side, spec).groupBy(spec.entity).agg(
        *[F.expr(make).alias(name) for name, (make, _) in parts.items()]
    )
    out = sums.select(
        spec.entity, F.lit(date).alias(spec.ref), *_outputs(spec, f"DATE '{date}'")
    )
    return out.orderBy(spec.entity) if sort else out


def backfill_features(
    facts: DataFrame,
    items: DataFrame,
    spec: FeatureSpec,
    dates: DateRange,
    tags: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """The feature set for every date of the range, in one job."""
    out = backfill_windows(facts, items, spec, [spec.months], dates, tags)
    return out.drop(WINDOW)


WINDOW = "months"
ALL_HISTORY = 0


def backfill_windows(
    facts: DataFrame,
    items: DataFrame,
    spec: FeatureSpec,
    windows: list[int | None],
    dates: DateRange,
    tags: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """The features for every date of the range and several windows, in one job.

    Rows carry their window in ``months`` (0 for all history). An item counts for
    the dates between its release and the end of the window, always one unbroken
    run of the range. Items with the same run are summed first: a few rows per date
    and window remain for each entity, however many credit rows there are, and
    running merges over them give every date (``spread_runs``): rows made grow with
    the dates, not with their square. The credit rows are read, folded and joined
    once for all windows.
    """
    dtype = items.schema[spec.release].dataType
    released = items.where(F.col(spec.release) < day_bound(dtype, F.lit(dates.last)))
    if None not in windows:
        oldest = F.add_months(F.lit(dates.first), -max(windows))
        released = released.where(F.col(spec.release) >= day_bound(dtype, oldest))
        facts = _windowed_facts(facts, items, released, spec)
    day = F.col("_day")
    runs_of_item = F.array(
        *[
            F.struct(
                F.lit(months or ALL_HISTORY).alias(WINDOW),
                dates.first_after(day).alias("from"),
                dates.last_within(day, months).alias("to"),
                block_of(day, F.lit(months or ALL_HISTORY)).alias("block"),
            )
            for months in windows
        ]
    )
    side = _item_side(released, spec, tags).withColumn(
        "_runs", F.filter(runs_of_item, lambda run: run["from"] <= run["to"])
    )
    parts = _partials(spec)
    runs = (
        _credited(facts, side.where(F.size("_runs") > 0), spec)
        .withColumn("_run", F.explode("_runs"))
        .groupBy(spec.entity, f"_run.{WINDOW}", "_run.block", "_run.from", "_run.to")
        .agg(*[F.expr(make).alias(name) for name, (make, _) in parts.items()])
    )
    per_date = spread_runs(runs, spec.entity, {name: merge for name, (_, merge) in parts.items()}, dates)
    return per_date.select(
        spec.entity,
        F.date_format("_date", "yyyy-MM-dd").alias(spec.ref),
        *_outputs(spec, "_date"),
        WINDOW,
    )


def block_of(day: Column, months: Column) -> Column:
    """The number of the block of ``months`` calendar months that ``day`` lies in; 0 for all history."""
    number = F.year(day) * 12 + F.month(day) - 1
    return F.when(months > 0, F.floor(number / months)).otherwise(0).cast("int")


def _block_start(block: Column, months: Column) -> Column:
    number = block * months
    return F.make_date(F.floor(number / 12).cast("int"), F.pmod(number, F.lit(12)) + 1, F.lit(1))


def run_marks(runs: DataFrame, dates: DateRange) -> DataFrame:
    """For each run the dates at which its parts enter or leave the sums of a block of dates.

    Dates are dealt to blocks as long as the window. An item released in a block
    counts for every later date of that block, and for the next block up to its
    run's end: it enters in its own block at ``from``, is there when the next one
    starts, and leaves after ``to``. Adds ``_block``, ``_at`` and ``_side`` (1 enters,
    -1 leaves, 0 only starts a block). At most three rows a run, whatever its length.
    """
    months, block = F.col(WINDOW), F.col("block")
    follows = dates.first_after(F.date_sub(_block_start(block + 1, months), 1))
    enters = F.struct(block.alias("block"), F.col("from").alias("at"), F.lit(1).alias("side"))
    starts = F.struct((block + 1).alias("block"), follows.alias("at"), F.lit(0).alias("side"))
    leaves = F.struct((block + 1).alias("block"), dates.first_after(F.col("to")).alias("at"), F.lit(-1).alias("side"))
    none = F.array().cast("array<struct<block:int,at:date,side:int>>")
    here = F.when(block_of(F.col("from"), months) == block, F.array(enters)).otherwise(none)
    there = F.when((months > 0) & (follows <= F.col("to")), F.array(starts, leaves)).otherwise(none)
    marked = runs.withColumn("_mark", F.explode(F.concat(here, there)))
    return marked.withColumns({"_block": F.col("_mark.block"), "_at": F.col("_mark.at"), "_side": F.col("_mark.side")}).drop("_mark")


def spread_runs(runs: DataFrame, entity: str, merges: dict[str, str], dates: DateRange) -> DataFrame:
    """One row per entity, window and date (``_date``) with the parts of all its runs at that date merged.

    No run is written out date by date. Within a block what has entered is a
    running merge forwards, what has not left yet one backwards; both together are
    the parts from one mark to the next, which hold for all dates between. Nothing
    is ever subtracted, so sums of fractions do not drift and least and greatest
    values work the same way. Rows made are the marks and the result.
    """
    marks = run_marks(runs, dates)
    keys = [entity, WINDOW, "_block"]
    # Partitioned for the windows at once: the sums per mark need no shuffle of their own.
    at = (
        marks.repartition(*keys)
        .groupBy(*keys, "_at")
        .agg(
            *[F.expr(f"{merge}({name}) FILTER (WHERE _side = 1) AS `_in{name}`") for name, merge in merges.items()],
            *[F.expr(f"{merge}({name}) FILTER (WHERE _side = -1) AS `_out{name}`") for name, merge in merges.items()],
        )
    )
    forwards = W.partitionBy(*keys).orderBy("_at")
    entered = forwards.rowsBetween(W.unboundedPreceding, W.currentRow)
    staying = W.partitionBy(*keys).orderBy(F.desc("_at")).rowsBetween(W.unboundedPreceding, -1)
    both = {"sum": "coalesce({0}, 0) + coalesce({1}, 0)", "min": "least({0}, {1})", "max": "greatest({0}, {1})"}
    merged = at.select(
        *keys,
        "_at",
        F.lead("_at").over(forwards).alias("_next"),
        *[F.expr(f"{merge}(`_in{name}`)").over(entered).alias(f"_in{name}") for name, merge in merges.items()],
        *[F.expr(f"{merge}(`_out{name}`)").over(staying).alias(f"_out{name}") for name, merge in merges.items()],
    ).select(
        *keys,
        "_at",
        "_next",
        *[F.expr(both[merge].format(f"`_in{name}`", f"`_out{name}`")).alias(name) for name, merge in merges.items()],
    )
    months = F.col(WINDOW)
    block_end = F.when(months > 0, F.date_sub(_block_start(F.col("_block") + 1, months), 1))
    until = F.least(F.date_sub("_next", 1), block_end, F.lit(dates.last))
    held = merged.where("_items > 0").withColumn("_until", until).where("_at <= _until")
    return held.withColumn("_date", F.explode(dates.between(F.col("_at"), F.col("_until"))))


def window_table(features: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The table of one windowed ``spec`` out of a ``backfill_windows`` result."""
    names = features.drop(WINDOW).columns
    keys = names[: len(names) - len(spec.features)]
    renamed = zip(names[len(keys) :], spec.features)
    return features.where(F.col(WINDOW) == (spec.months or ALL_HISTORY)).select(
        *keys, *[F.col(name).alias(feature.name) for name, feature in renamed]
    )
