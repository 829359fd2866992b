"""The four steps end to end: landing, keyed tables, entity tables, features."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.columns import decode, epoch_text, epoch_timestamp
from tidemark.functions.dates import DateRange
from tidemark.operators.dedup import latest_per_key, split_null_keys
from tidemark.operators.features import WINDOW, backfill_features, backfill_windows, window_table
from tidemark.operators.shape import explode_bridge, sorted_entity, stamp
from tidemark.plans import catalogue as cat
from tidemark.plans.feature_spec import FeatureSpec
from tidemark.sinks.keyed_table import KeyedTable
from tidemark.sinks.storage import remove, shared_dir
from tidemark.sinks.tables import save_full, write_backfill
from tidemark.sources.landing import landing_options, read_accounted, read_landing, resolve_schema
from tidemark.sources.pages import UNKEYED, UNREADABLE, read_pages
from tidemark.sources.tables import read_table
from tidemark.streaming.upserts import checkpoint_for, stream_landing, upsert_stream

Tables = Mapping[str, DataFrame]


def _scanned(
    spark: SparkSession, landing: str, fmt: str, schema: T.StructType | str | None, options: Mapping[str, str]
) -> tuple[DataFrame, DataFrame | None]:
    """(rows, rejects as file, pos, reason and record; None where the format has none)."""
    if fmt != "json":
        return read_landing(spark, landing, fmt, schema, **options), None
    if landing_options(fmt, dict(options))["multiLine"].lower() == "true":
        return read_pages(spark, landing, schema)
    declared = resolve_schema(spark, landing, fmt, schema, **options)
    rows, bad = read_accounted(spark, landing, declared, fmt, **options)
    # Spark refuses to read the raw text alone: nothing of what else was read is added to it.
    nothing = F.left(F.to_json(F.struct(*declared.names)), F.lit(0))
    return rows, bad.select(
        "file", F.lit(None).cast("int").alias("pos"), F.lit(UNREADABLE).alias("reason"), F.concat("record", nothing).alias("record")
    )


def process_full(
    spark: SparkSession,
    landing: str,
    path: str,
    ids: list[str],
    ts: str,
    fmt: str = "json",
    schema: T.StructType | str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: tuple[str, ...] = (),
    rejects: str | None = None,
    **options: str,
) -> None:
    """Full load: scan, keep the latest row per key (or ``transform``), overwrite.

    No record is lost unseen: those that cannot be read, do not fit the schema or
    lack a key replace the table ``rejects`` (by default beside ``path``) with
    their file, place, reason and text, before the table itself is replaced.
    """
    df, bad = _scanned(spark, landing, fmt, schema, options)
    if transform:
        out = df.transform(transform)
    else:
        df, loose = split_null_keys(df, ids)
        out = stamp(latest_per_key(df, ids, ts))
        none = F.lit(None)
        unkeyed = loose.select(
            none.cast("string").alias("file"), none.cast("int").alias("pos"), F.lit(UNKEYED).alias("reason"), F.to_json(F.struct("*")).alias("record")
        )
        bad = unkeyed if bad is None else bad.unionByName(unkeyed)
    if bad is not None:
        save_full(bad, rejects or f"{path.rstrip('/')}_rejects")
    save_full(out, path, partition_by)


@dataclass(frozen=True)
class Ingest:
    """How an endpoint's landing files are read and which row of a key is kept."""

    ids: tuple[str, ...] = tuple(cat.KEY)
    ts: str = cat.VERSION
    mode: str = "last_write"
    tie: tuple[str, ...] = ()
    fmt: str = "json"
    options: Mapping[str, str] = field(default_factory=dict)


def ingest_stream(
    spark: SparkSession,
    landing: str,
    path: str,
    endpoint: str,
    schema: T.StructType | str | None = None,
    checkpoint: str | None = None,
    how: Ingest = Ingest(),
    rejects: str | None = None,
) -> KeyedTable:
    """Upsert the new landing files of an endpoint into its keyed table.

    ``how.options`` are the reader's, such as ``maxFilesPerTrigger`` to take a
    backlog in several batches. Rows without a complete key, which is what an
    unreadable page becomes, go to ``rejects`` (by default beside the table).
    """
    declared = resolve_schema(
        spark, landing, how.fmt, declared=schema or cat.LANDING_SCHEMAS.get(endpoint), **how.options
    )
    rejects = rejects or f"{path.rstrip('/')}_rejects"
    table = KeyedTable(spark, path, declared, list(how.ids), how.ts, how.mode, how.tie, rejects)
    stream = stream_landing(spark, landing, declared, how.fmt, **how.options)
    upsert_stream(stream, table, checkpoint or checkpoint_for(landing, endpoint))
    return table


def entity_table(landing: DataFrame, spec: cat.EntitySpec, typed: bool = False) -> DataFrame:
    """An entity table: pruned, renamed, decoded, epochs converted.

    Date-times are text unless ``typed``; real timestamps filter better.
    """
    convert = epoch_timestamp if typed else epoch_text
    if spec.sort:
        # Sorted before projecting: the shuffle carries numbers, not date-time texts.
        landing = sorted_entity(landing, spec.sort, spec.spread)
    out = []
    for source, name in spec.columns.items():
        col = F.col(source)
        if source in spec.codes:
            col = decode(col, *spec.codes[source])
        elif source in cat.EPOCH_COLUMNS:
            col = convert(col)
        out.append(col.alias(name))
    return landing.select(*out)


def bridge_table(landing: DataFrame, spec: cat.BridgeSpec) -> DataFrame:
    rows = explode_bridge(landing, "id", spec.array, spec.id_out, spec.item_out)
    return rows.select(spec.item_out, spec.id_out) if spec.item_first else rows


def silver_tables(landing: Tables, own: str, typed: bool = False) -> dict[str, DataFrame]:
    """All entity and bridge tables whose landing table is given."""
    out = {
        name: entity_table(landing[spec.source], spec, typed)
        for name, spec in cat.entity_tables(own).items()
        if spec.source in landing
    }
    for name, spec in cat.BRIDGE_TABLES.items():
        if spec.source in landing:
            out[name] = bridge_table(landing[spec.source], spec)
    return out


def refresh(df: DataFrame, path: str) -> None:
    """Recompute a table and overwrite it, schema included."""
    save_full(df, path)


def feature_inputs(
    tables: Tables, spec: FeatureSpec
) -> tuple[DataFrame, DataFrame, tuple[DataFrame, DataFrame] | None]:
    """(credit rows, items, tags) of a feature set, from the silver tables."""
    tags = None
    if spec.tag is not None:
        bridge, dim = cat.TAG_TABLES[spec.tag]
        tags = (tables[bridge], tables[dim])
    return tables["involved_companies"], tables["games"], tags


@dataclass(frozen=True)
class BackfillJob:
    """One backfill: which set, for which dates."""

    table: str
    dates: DateRange
    id_fields: tuple[str, ...] = ("idCompany",)
    partition: str = "dtRef"
    description: str = ""

    @classmethod
    def from_record(cls, record: Mapping) -> BackfillJob:
        """From a JSON job record; ``monthly`` may be a boolean or text, else daily."""
        ids = record["id_fields"]
        monthly = str(record.get("monthly", False)) == "True"
        return cls(
            table=record["table"],
            dates=DateRange(record["date_start"], record["date_stop"], "monthly" if monthly else "daily"),
            id_fields=tuple(i.strip() for i in ids.split(",")) if isinstance(ids, str) else tuple(ids),
            partition=record.get("partition_fields", "dtRef"),
            description=record.get("description", ""),
        )


def run_backfill(job: BackfillJob, tables: Tables, path: str, own: str) -> None:
    """Compute all dates of the job in one pass and replace their partitions."""
    spec = cat.feature_sets(own)[job.table]
    if job.id_fields != (spec.entity,):
        raise ValueError(f"{job.table} is keyed by {spec.entity}, not {', '.join(job.id_fields)}")
    facts, items, tags = feature_inputs(tables, spec)
    write_backfill(backfill_features(facts, items, spec, job.dates, tags), path, job.dates, job.partition)


def run_backfill_kind(
    spark: SparkSession, kind: str, dates: DateRange, tables: Tables, paths: Mapping[str, str], own: str
) -> None:
    """Backfill a set and its windowed forms together (``paths`` maps set to table).

    The credit rows are joined once and the result of all windows written once,
    to the shared folder; each table is then a filtered copy of its own window.
    """
    sets = {name: spec for name, spec in cat.feature_sets(own).items() if name.startswith(kind)}
    base = sets[kind]
    facts, items, tags = feature_inputs(tables, base)
    windows = [spec.months for spec in sets.values()]
    features = backfill_windows(facts, items, base, windows, dates, tags)
    staged = shared_dir(spark, "windows")
    save_full(features, staged, [WINDOW])
    for name, spec in sets.items():
        table = window_table(read_table(spark, staged, features.schema), spec)
        write_backfill(table, paths[name], dates, spec.ref)
    remove(spark, staged)
