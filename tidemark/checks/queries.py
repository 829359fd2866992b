"""One query per operator or table; each takes (spark, directory of the sample tables)."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.checks.views import OWN, Sample
from tidemark.functions.columns import epoch_text
from tidemark.functions.dates import DateRange, month_ends
from tidemark.operators.asof import asof_join, spine
from tidemark.operators.bitmaps import ALL, distinct_counts, item_bitmaps
from tidemark.operators.contract import feature_projection
from tidemark.operators.dedup import latest_per_key, profile_key
from tidemark.operators.features import (
    attach_items,
    backfill_features,
    backfill_windows,
    build_features,
    flag_counts,
    flag_shares,
)
from tidemark.operators.shape import (
    before,
    decode,
    explode_bridge,
    rename,
    sorted_entity,
    trailing,
    with_ref_date,
)
from tidemark.operators.upsert import upsert
from tidemark.plans import catalogue as cat
from tidemark.plans.medallion import Ingest, bridge_table, entity_table, feature_inputs, ingest_stream, process_full, refresh, silver_tables
from tidemark.sinks import KeyedTable, ensure_table, replace_partition, save_full, shared_dir, write_backfill
from tidemark.sources import extract_since_mark, incremental_extract, read_accounted, read_landing, read_pages, read_partition, read_table, resolve_schema
from tidemark.streaming import stream_landing, upsert_in_state, upsert_stream

Query = Callable[[SparkSession, str], DataFrame]

# Reference date per window: each cuts the sample orders (1995 to 2001) somewhere inside.
DATES = {None: "1999-06-01", 12: "1999-06-01", 60: "2001-06-01", 120: "2008-06-01"}
DAILY = DateRange("1999-05-20", "1999-06-10", "daily")
MONTHLY = DateRange("1998-11-15", "2000-03-01", "monthly")
YEARLY = DateRange("1996-01-01", "2001-12-31", "yearly")
SPLIT = dt.datetime(2024, 1, 16)
LAST_RUN = dt.datetime(2024, 1, 28)
# Of the stateful stream's events, one in so many comes with the last run.
HELD_BACK = 3


# --- feature sets ---------------------------------------------------------------


def _feature_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        s, spec = Sample(spark, sf_dir), cat.feature_sets(OWN)[name]
        sort = spec.tag is not None and spec.months is None
        return build_features(s.credits(), s.items(), spec, DATES[spec.months], s.tags(spec.tag), sort)

    return query


def _theme_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Sample(spark, sf_dir)
    spec = cat.feature_sets(OWN)["company_themes"]
    spec = dataclasses.replace(spec, features=cat.theme_features(count_untagged=True))
    return build_features(s.credits(), s.items(), spec, DATES[None], s.tags(spec.tag))


def _backfill_query(name: str, dates: DateRange) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        s, spec = Sample(spark, sf_dir), cat.feature_sets(OWN)[name]
        return backfill_features(s.credits(), s.items(), spec, dates, s.tags(spec.tag))

    return query


def _released_credits(s: Sample) -> DataFrame:
    return attach_items(s.credits(), s.items().select("idGame", "dtRelease"), "idGame")


ROLE_FLAGS = {
    "qtdeDeveloper": "flDeveloper",
    "qtdePublisher": "flPublisher",
    "qtdeBoth": "flDeveloper AND flSupporting",
}


def _flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_counts(_released_credits(Sample(spark, sf_dir)), "idCompany", "idGame", ROLE_FLAGS)


def _flag_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_shares(_released_credits(Sample(spark, sf_dir)), "idCompany", "idGame", ROLE_FLAGS)


def _filter_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = before(Sample(spark, sf_dir).items(), "dtRelease", DATES[None])
    return with_ref_date(rows.select("idGame", "dtRelease"), DATES[None])


def _filter_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trailing(Sample(spark, sf_dir).items(), "dtRelease", DATES[60], 60).select("idGame", "dtRelease")


# --- silver ---------------------------------------------------------------------


def _entity_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = cat.entity_tables(OWN)[name]
        table = entity_table(Sample(spark, sf_dir).landing(spec.source), spec)
        # The array column is shown as text, for the comparison.
        arrays = [c for c, kind in table.dtypes if kind == "array<bigint>"]
        return table.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",", "-") for c in arrays})

    return query


def _bridge_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = cat.BRIDGE_TABLES[name]
        return bridge_table(Sample(spark, sf_dir).landing(spec.source), spec)

    return query


def _rename_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    events = Sample(spark, sf_dir).table("events").withColumn("created", epoch_text(seconds))
    return rename(
        events, {"event_id": "idEvent", "user_id": "idUser", "event_type": "descType", "created": "dtCreated"}
    )


def _decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = {0: "north", 1: "south", 2: "east", 3: "west"}
    nation = Sample(spark, sf_dir).table("nation")
    return decode(nation, "n_regionkey", labels, "elsewhere", "descRegion").select("n_nationkey", "descRegion")


def _bridge_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = Sample(spark, sf_dir).table("documents").select("doc_id", F.split("text", " ").alias("words"))
    return explode_bridge(words, "doc_id", "words", "idDocument", "descWord")


def _sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = rename(
        Sample(spark, sf_dir).table("orders"),
        {"o_custkey": "idCustomer", "o_orderkey": "idOrder", "o_totalprice": "vlPrice"},
    )
    return sorted_entity(orders, ["idCustomer"], ["idOrder"])


# --- bronze ---------------------------------------------------------------------


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(Sample(spark, sf_dir).table("events"), ["user_id"], "ts", tie=["event_id"])


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = Sample(spark, sf_dir).table("events")
    loose = events.withColumn("user_id", F.when(F.col("event_type") != "error", F.col("user_id")))
    return profile_key(loose, ["user_id"])


def _profile_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_key(Sample(spark, sf_dir).table("lineitem"), ["l_orderkey", "l_linenumber"])


def _incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_extract(Sample(spark, sf_dir).table("events"), "ts", F.lit(SPLIT).cast("timestamp_ntz"))


def _slices(s: Sample) -> tuple[DataFrame, DataFrame]:
    events = s.table("events")
    split = F.lit(SPLIT).cast("timestamp_ntz")
    old = latest_per_key(events.where(F.col("ts") < split), ["user_id"], "ts", tie=["event_id"])
    new = latest_per_key(events.where(F.col("ts") >= split), ["user_id"], "ts", tie=["event_id"])
    return old, new


def _upsert_last_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _slices(Sample(spark, sf_dir))
    return upsert(new, old, ["user_id"])  # the late batch holds the older rows, and wins


def _upsert_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _slices(Sample(spark, sf_dir))
    return upsert(new, old, ["user_id"], mode="newest", ts="ts")


def _upsert_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = Sample(spark, sf_dir).table("lineitem")
    keys = ["l_orderkey", "l_linenumber"]

    def total(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.round(F.sum("l_quantity"), 2).alias("qty"), F.max("l_returnflag").alias("flag"))

    returned = F.col("l_returnflag") == "R"
    return upsert(total(lines.where(~returned)), total(lines.where(returned)), keys)


# Months of release from the first on, before the second.
BITMAP_WINDOWS = (("1998-01", "1999-01"), ("1998-06", "1999-06"), ("1995-01", "2000-01"))
EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _keyed_table(mode: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = Sample(spark, sf_dir).table("events")
        table = KeyedTable(
            spark, shared_dir(spark, "keyed"), EVENT_SCHEMA, ["user_id"], "ts", mode, tie=["event_id"]
        )
        table.ensure()
        table.apply(events.where(F.col("ts") >= F.lit(SPLIT).cast("timestamp_ntz")), "late")
        table.compact()
        for _ in range(2):  # the second, as after a lost driver, changes nothing
            table.apply(events.where(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz")), "early")
        return table.read()

    return query


def _stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = shared_dir(spark, "stream")
    stream = stream_landing(spark, f"{sf_dir}/events*.parquet", EVENT_SCHEMA, "parquet")
    table = KeyedTable(spark, f"{home}/events", EVENT_SCHEMA, ["user_id"], "ts", tie=["event_id"])
    upsert_stream(stream, table, f"{home}/checkpoint")
    return table.read()


def _stream_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs on one checkpoint; the last brings rows of days that are closed by then."""
    home = shared_dir(spark, "stateful")
    events = Sample(spark, sf_dir).table("events")
    early, last = (F.col("ts") < F.lit(t).cast("timestamp_ntz") for t in (SPLIT, LAST_RUN))
    held_back = F.col("event_id") % HELD_BACK == 0
    table = KeyedTable(spark, f"{home}/events", EVENT_SCHEMA, ["user_id", "event_type"], "ts", "newest", tie=["event_id"])
    for part in (early & ~held_back, ~early & last & ~held_back, ~last | held_back):
        events.where(part).select(*table.schema.names).write.mode("append").parquet(f"{home}/landing")
        upsert_in_state(stream_landing(spark, f"{home}/landing", EVENT_SCHEMA, "parquet"), table, f"{home}/checkpoint", "2 days")
    return table.read()


def _landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Sample(spark, sf_dir).table("events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("user"),
        F.col("event_type").alias("kind"),
        F.col("value"),
        F.col("props"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("updated_at"),
    )


def _landing_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = shared_dir(spark, "landing")
    _landing_rows(spark, sf_dir).write.json(landing)
    inferred = resolve_schema(spark, landing, multiLine="false")
    return read_landing(spark, landing, schema=inferred, multiLine="false").select(
        "id", "user", "kind", "value", "props", "updated_at"
    )


def _landing_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records cut short on the way: the whole ones as rows, of the others what is left of them."""
    landing, rows = shared_dir(spark, "landing"), _landing_rows(spark, sf_dir).drop("props")
    whole = F.to_json(F.struct("*"))
    rows.select(F.when(F.col("id") % 50 == 0, F.substring(whole, 1, 12)).otherwise(whole)).write.text(landing)
    good, bad = read_accounted(spark, landing, rows.schema, multiLine="false")
    left = bad.drop("file").withColumnRenamed("record", "rest")
    return good.unionByName(left, allowMissingColumns=True)


def _process_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = shared_dir(spark, "full")
    _landing_rows(spark, sf_dir).write.parquet(f"{home}/landing")
    process_full(spark, f"{home}/landing", f"{home}/table", ["user"], "updated_at", fmt="parquet")
    stamped = F.col("ingestion_at").isNotNull()
    return read_table(spark, f"{home}/table").withColumn("ingestion_at", stamped)


def _write_pages(spark: SparkSession, sf_dir: str) -> str:
    """Pages of 500 records over several lines; every fiftieth holds a text where a number belongs."""
    landing, rows = shared_dir(spark, "pages"), _landing_rows(spark, sf_dir)
    others = [c for c in rows.columns if c != "value"]
    text = F.when(F.col("id") % 50 == 0, F.to_json(F.struct(*others, F.lit("n/a").alias("value")))).otherwise(F.to_json(F.struct("*")))
    records = F.array_join(F.sort_array(F.collect_list("text")), ",\n  ")
    pages = rows.select(F.expr("id div 500").alias("page"), text.alias("text")).groupBy("page").agg(records.alias("r"))
    pages.select(F.concat(F.lit("[\n  "), "r", F.lit("\n]"))).write.option("maxRecordsPerFile", 1).text(landing)
    return landing


def _landing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of every page, and of those that do not fit the schema their id."""
    landing, schema = _write_pages(spark, sf_dir), _landing_rows(spark, sf_dir).schema
    good, bad = read_pages(spark, landing, schema)
    rejected = bad.select(F.get_json_object("record", "$.id").cast("long").alias("rejected_id"), "reason")
    return good.unionByName(rejected, allowMissingColumns=True)


def _landing_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a schema the mixed column is text, so that no record is lost."""
    landing = _write_pages(spark, sf_dir)
    good, bad = read_pages(spark, landing)
    kept = good.withColumn("value", F.coalesce(F.expr("try_cast(value AS DOUBLE)"), F.lit(-1.0)))
    return kept.withColumn("rejected", bad.agg(F.count("*")).scalar())


def _process_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full load of multi-line pages: the records that do not fit are counted, the others keep their rows."""
    landing, table = _write_pages(spark, sf_dir), shared_dir(spark, "full")
    schema = _landing_rows(spark, sf_dir).schema
    process_full(spark, landing, table, ["user"], "updated_at", schema=schema, rejects=f"{table}_rejects")
    rejected = read_table(spark, f"{table}_rejects").agg(F.count("*")).scalar()
    return read_table(spark, table).withColumns({"ingestion_at": F.col("ingestion_at").isNotNull(), "rejected": rejected})


def _process_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full load through a query of the caller's own over the landing rows."""
    home = shared_dir(spark, "full")
    _landing_rows(spark, sf_dir).write.parquet(f"{home}/landing")

    def by_kind(rows: DataFrame) -> DataFrame:
        return rows.groupBy("kind").agg(F.count("*").alias("n"), F.max("updated_at").alias("last"), F.count_distinct("user").alias("users"))

    process_full(spark, f"{home}/landing", f"{home}/table", ["id"], "updated_at", fmt="parquet", transform=by_kind)
    return read_table(spark, f"{home}/table")


def _silver_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver table refreshed twice, the second time with other columns."""
    path, tables = shared_dir(spark, "silver"), cat.entity_tables(OWN)
    for name in ("genres", "companies"):
        refresh(entity_table(Sample(spark, sf_dir).landing(tables[name].source), tables[name]), path)
    return read_table(spark, path)


def _table_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue table created empty, written, and computed anew from itself."""
    home = shared_dir(spark, "catalogue")
    base = "checks_" + home.rpartition("-")[2]
    spark.sql(f"CREATE DATABASE {base} LOCATION '{home}'")
    name = f"{base}.months"
    ensure_table(spark, name, ORDERS_BY_MONTH, ["dtRef"])
    save_full(_orders_by_month(Sample(spark, sf_dir)), name, ["dtRef"])
    ensure_table(spark, name, ORDERS_BY_MONTH, ["dtRef"])
    doubled = read_table(spark, name).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    save_full(doubled.where("dtRef >= '1998-07'"), name, ["dtRef"])
    return read_table(spark, name)


def _marked_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over a growing landing folder with a stored mark; the last finds nothing new."""
    home, events = shared_dir(spark, "marked"), Sample(spark, sf_dir).table("events")
    table = KeyedTable(spark, f"{home}/events", EVENT_SCHEMA, ["user_id"], "ts", "newest", tie=["event_id"])
    table.ensure()
    late = F.col("ts") >= F.lit(SPLIT).cast("timestamp_ntz")
    for run, part in enumerate([events.where(late), events.where(~late), None]):
        if part is not None:
            part.write.mode("append").parquet(f"{home}/landing")
        rows, move = extract_since_mark(spark, f"{home}/landing", f"{home}/mark.json", "parquet", EVENT_SCHEMA)
        table.apply(rows, f"run-{run}")
        move()
    return table.read()


def _bitmap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct items per company over overlapping windows, from bitmaps by month of release; every item is listed twice."""
    s = Sample(spark, sf_dir)
    items = s.items().select("idGame", F.date_format("dtRelease", "yyyy-MM").alias("month"))
    credits = s.credits().join(items.unionAll(items), "idGame")
    monthly = item_bitmaps(credits, "idCompany", "idGame", {n: p for n, p in ROLE_FLAGS.items()}, ["month"])
    windows = [F.struct(F.lit(first).alias("from"), F.lit(last).alias("to")) for first, last in BITMAP_WINDOWS]
    spread = monthly.withColumn("w", F.explode(F.array(*windows))).where("month >= w.from AND month < w.to")
    keyed = spread.select("*", F.col("w.to").alias("until")).drop("w")
    return distinct_counts(keyed, ["idCompany", "until"], {ALL: "qtdeGames", **{n: n for n in ROLE_FLAGS}})


def _chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON landing to keyed tables, in two runs on one checkpoint, to entity tables, to features."""
    s, home, bronze = Sample(spark, sf_dir), shared_dir(spark, "chain"), {}
    # Some credits share an id: all their columns decide which one is kept.
    ties = {"games": (), "involved_companies": ("company", "developer", "porting", "publisher", "supporting")}
    for endpoint, tie in ties.items():
        how = Ingest(mode="newest", tie=tie, options={"multiLine": "false"})
        rows, landing = s.landing(endpoint), f"{home}/landing/{endpoint}"
        older = rows.where("id % 6 = 3").withColumn("updated_at", F.col("updated_at") - 1)
        older = older.withColumn("created_at", F.lit(0).cast("long"))
        for part in (rows.where("id % 2 = 0").unionByName(older, allowMissingColumns=True), rows.where("id % 2 = 1")):
            part.write.mode("append").json(landing, compression="gzip")
            table = ingest_stream(spark, landing, f"{home}/bronze/{endpoint}", endpoint, how=how)
        bronze[endpoint] = table.read()
    spec = cat.feature_sets(OWN)["company_general_05_years"]
    facts, items, tags = feature_inputs(silver_tables(bronze, OWN), spec)
    out = build_features(facts, items, spec, DATES[60], tags)
    return out.withColumns({c: F.round(c, 6) for c, kind in out.dtypes if kind == "double"})


# --- partitioned feature tables ---------------------------------------------------


def _orders_by_month(s: Sample) -> DataFrame:
    return s.table("orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("dtRef")
    )


ORDERS_BY_MONTH = "o_orderkey long, o_totalprice double, dtRef string"


def _partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = _orders_by_month(Sample(spark, sf_dir)), shared_dir(spark, "months")
    ensure_table(spark, path, ORDERS_BY_MONTH, ["dtRef"])
    save_full(rows, path, ["dtRef"])
    doubled = rows.where("dtRef = '1998-07'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    replace_partition(doubled, path, "dtRef", "1998-07")
    replace_partition(rows.where("false"), path, "dtRef", "1998-08")
    return read_table(spark, path, ORDERS_BY_MONTH)


def _read_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "months")
    save_full(_orders_by_month(Sample(spark, sf_dir)), path, ["dtRef"])
    return read_partition(spark, path, "dtRef", "1999-02", ORDERS_BY_MONTH)


def _backfill_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, spec = Sample(spark, sf_dir), cat.feature_sets(OWN)["company_general_01_years"]
    path = shared_dir(spark, "backfill")
    for dates in (MONTHLY, DateRange("1999-01-01", "1999-04-01", "monthly")):  # the second run overlaps
        features = backfill_features(s.credits(), s.items(), spec, dates)
        write_backfill(features, path, dates)
    return read_table(spark, path, features.schema)


def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = Sample(spark, sf_dir).table("customer").select(F.col("c_custkey").alias("idCompany"))
    return spine(ids, month_ends("2021-12-01", "2022-12-01"))


def _asof_events(max_age: dt.timedelta | None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = Sample(spark, sf_dir).table("events")
        buys = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
        views = events.where("event_type = 'view'").select(
            "user_id", F.col("ts").alias("seen"), F.col("event_id").alias("view_id"), F.col("value").alias("view_value")
        )
        return asof_join(buys, views, "user_id", "ts", "seen", max_age, tie=["view_id"])

    return query


def _asof_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored features read back for every supplier at month ends, as they were known then."""
    s, spec = Sample(spark, sf_dir), cat.feature_sets(OWN)["company_general_01_years"]
    path = shared_dir(spark, "features")
    features = backfill_features(s.credits(), s.items(), spec, YEARLY)
    write_backfill(features, path, YEARLY)
    feats = read_table(spark, path, features.schema)
    ids = s.table("supplier").select(F.col("s_suppkey").alias("idCompany"))
    return asof_join(spine(ids, month_ends("1995-06-01", "2002-06-30")), feats, "idCompany", "event_timestamp", "dtRef")


def _backfill_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, spec = Sample(spark, sf_dir), cat.feature_sets(OWN)["company_general"]
    windows = [None, *[12 * years for years in cat.WINDOW_YEARS]]
    return backfill_windows(s.credits(), s.items(), spec, windows, YEARLY)


def _projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, spec = Sample(spark, sf_dir), cat.feature_sets(OWN)["company_platform_05_years"]
    feats = build_features(s.credits(), s.items(), spec, DATES[60], s.tags(spec.tag))
    out = feature_projection(feats)
    return out.withColumns({c: F.round(F.col(c).cast("double"), 5) for c, kind in out.dtypes if kind == "float"})


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    names = {"company_general": "feature_general", "company_genre": "feature_share_genre",
             "company_platform": "feature_share_platform", "company_themes": "feature_share_theme"}
    for name, spec in cat.feature_sets(OWN).items():
        base = next(b for b in names if name.startswith(b))
        window = "" if spec.tag == "idTheme" else "_all" if spec.months is None else f"_{spec.months // 12:02d}y"
        out[names[base] + window] = _feature_query(name)
    out |= {f"silver_{name}": _entity_query(name) for name in cat.entity_tables(OWN)}
    out |= {f"silver_{name}": _bridge_query(name) for name in cat.BRIDGE_TABLES}
    out |= {
        "feature_share_theme_counted": _theme_fixed,
        "flag_counts": _flag_counts,
        "flag_shares": _flag_shares,
        "filter_before": _filter_before,
        "filter_trailing": _filter_trailing,
        "silver_rename_epoch": _rename_epoch,
        "silver_decode": _decode,
        "silver_bridge_words": _bridge_words,
        "silver_sorted_entity": _sorted,
        "bronze_latest_per_key": _latest,
        "bronze_profile": _profile,
        "bronze_profile_composite": _profile_composite,
        "bronze_incremental_extract": _incremental,
        "upsert_last_write": _upsert_last_write,
        "upsert_newest": _upsert_newest,
        "upsert_composite_key": _upsert_composite,
        "keyed_table_last_write": _keyed_table("last_write"),
        "keyed_table_newest": _keyed_table("newest"),
        "stream_upsert": _stream_upsert,
        "stream_upsert_stateful": _stream_stateful,
        "landing_json_roundtrip": _landing_json,
        "landing_bad_records": _landing_bad,
        "chain_landing_to_features": _chain,
        "bronze_marked_extract": _marked_extract,
        "bitmap_window_counts": _bitmap_counts,
        "landing_pages": _landing_pages,
        "landing_pages_inferred": _landing_inferred,
        "bronze_process_full": _process_full,
        "bronze_process_pages": _process_pages,
        "bronze_process_transform": _process_transform,
        "silver_refresh": _silver_refresh,
        "table_by_name": _table_by_name,
        "backfill_daily": _backfill_query("company_general", DAILY),
        "backfill_monthly": _backfill_query("company_general_01_years", MONTHLY),
        "backfill_yearly": _backfill_query("company_general_05_years", YEARLY),
        "backfill_genre_monthly": _backfill_query("company_genre_01_years", MONTHLY),
        "backfill_platform_daily": _backfill_query("company_platform_05_years", DAILY),
        "backfill_theme_yearly": _backfill_query("company_themes", YEARLY),
        "backfill_windows": _backfill_windows,
        "backfill_table": _backfill_table,
        "partition_replace": _partition_replace,
        "partition_read": _read_partition,
        "spine_month_end": _spine,
        "asof_events": _asof_events(None),
        "asof_events_max_age": _asof_events(dt.timedelta(days=2)),
        "asof_features": _asof_features,
        "feature_projection": _projection,
    }
    return out
