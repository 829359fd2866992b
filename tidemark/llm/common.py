"""What the operators share: text normalisation, scratch tables, joins that survive hot keys."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.sinks.storage import checkpoint_dir

# A key is heavy if it has over 1/HEAVY_ONE_IN of the rows: under HEAVY_ONE_IN keys can be.
HEAVY_ONE_IN = 1024
# Below so many rows a key fits one task anyhow.
HEAVY_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The same rows read back from the shared checkpoint folder: computed once, no lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lower_ascii(text: bytes | None) -> bytes:
    """UTF-8 with A-Z lowered and nothing else; null counts as empty."""
    return text.lower() if text else b""


def words_of(text: bytes | None) -> list[bytes]:
    """Lowered runs of anything but space and the controls 9 to 13."""
    return text.lower().split() if text else []


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[dict] | None], schema: T.StructType | str
) -> DataFrame:
    """``mapInArrow`` with a function from a batch to columns (dicts of lists)."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(kind)
        for batch in batches:
            for part in _slices(batch):
                for columns in function(part):
                    yield pa.RecordBatch.from_arrays(
                        [
                            columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
                            for f in arrow
                        ],
                        schema=arrow,
                    )

    return df.mapInArrow(run, kind)


def _slices(batch: pa.RecordBatch, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def join_counted(
    rows: DataFrame, unique: DataFrame, keys: list[str], count: str, spread: Column, distinct: bool = False, how: str = "inner"
) -> DataFrame:
    """Join (inner or left) of ``rows`` with ``unique``, which has one row per key and in ``count`` how many rows it meets.

    As the counts are exact, the heavy keys are known: under ``HEAVY_ONE_IN``
    of them, so their list is broadcast. Rows of a heavy key are dealt over
    sub-keys by ``spread``, with one copy of its row in ``unique`` for each.
    ``distinct`` drops repeated rows of the result without another shuffle.
    """
    total = unique.agg(F.sum(count)).first()[0] or 0
    limit = max(total // HEAVY_ONE_IN, HEAVY_ROWS)
    salts = F.ceil(F.col(count) / F.lit(limit)).cast("int")
    heavy = unique.where(F.col(count) > limit).select(*keys, salts.alias("_salts"))
    left = rows.join(F.broadcast(heavy), keys, "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(spread), "_salts"), F.lit(0)).cast("int")
    )
    copies = F.when(F.col(count) > limit, F.sequence(F.lit(0), salts - 1)).otherwise(F.array(F.lit(0)))
    right = unique.withColumn("_salt", F.explode(copies))
    joined = left.drop("_salts").join(right, [*keys, "_salt"], how)
    return (joined.distinct() if distinct else joined).drop("_salt")


def with_digest(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """``docs`` with the SHA-256 of the lowered text as a binary column."""

    names = docs.columns

    def digest(batch):
        texts = batch.column(0).to_pylist()
        rest = {n: batch.column(i + 1) for i, n in enumerate(names)}
        yield {name: [hashlib.sha256(lower_ascii(t)).digest() for t in texts], **rest}

    bare = fresh(docs, "_text")
    schema = T.StructType([T.StructField(name, T.BinaryType()), *docs.schema.fields])
    return map_batches(docs.select(F.col(text_col).cast("binary").alias(bare), "*"), digest, schema)


def keep_rows(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose (``doc_id``, ``digest``) is in ``keys``, each pair once.

    Null ids match null ids. Rows that repeat both id and text are one document:
    if they differ elsewhere, the one whose columns have the smallest hash stays.
    They are folded by task before they meet, however many they are.
    """
    digest, key, none = (fresh(docs, n) for n in ("_digest", "_key", "_none"))
    match = [key, none, digest]
    left = with_digest(docs, text_col, digest).withColumns(
        {key: F.coalesce(F.col(id_col).cast("long"), F.lit(0)), none: F.col(id_col).isNull()}
    )
    right = keys.select(
        F.coalesce("doc_id", F.lit(0)).alias(key), F.col("doc_id").isNull().alias(none), F.col("digest").alias(digest)
    )
    # Maps and the like cannot be hashed; as text they can.
    plain = {f.name: not any(kind in f.dataType.simpleString() for kind in ("map<", "variant")) for f in docs.schema}
    hashed = [F.col(f"`{n}`") if plain[n] else F.to_json(F.struct(f"`{n}`")) for n in docs.columns]
    row = fresh(docs, "_row")
    folded = left.groupBy(*match).agg(
        F.min_by(F.struct(*[F.col(f"`{n}`") for n in docs.columns]), F.xxhash64(*hashed)).alias(row)
    )
    return folded.join(right, match, "left_semi").select(f"{row}.*")
