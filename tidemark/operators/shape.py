"""Row-shaping operators: rename, decode, epoch conversion, bridges, stamps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import decode as decode_column
from tidemark.functions.columns import day_bound, epoch_text, epoch_timestamp


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep only the mapped columns, in order, under their new names."""
    return df.select(*[F.col(source).alias(target) for source, target in names.items()])


def decode(
    df: DataFrame, col: str, labels: Mapping[int | str, str], default: str, out: str
) -> DataFrame:
    """Add ``out``: the label of code ``col``, or ``default``."""
    return df.withColumn(out, decode_column(F.col(col), labels, default))


def epoch_to_ts(df: DataFrame, cols: Sequence[str], as_string: bool = False) -> DataFrame:
    """Convert epoch-second columns in place to timestamps or date-time text."""
    convert = epoch_text if as_string else epoch_timestamp
    return df.withColumns({name: convert(F.col(name)) for name in cols})


def explode_bridge(df: DataFrame, id_col: str, arr_col: str, id_out: str, item_out: str) -> DataFrame:
    """Array column to (id, element) rows.

    NULL and empty arrays give no row; a NULL element gives a row with NULL.
    """
    return df.select(F.col(id_col).alias(id_out), F.explode(arr_col).alias(item_out))


def with_ref_date(df: DataFrame, date: str, name: str = "dtRef") -> DataFrame:
    return df.withColumn(name, F.lit(date))


def stamp(df: DataFrame, col: str = "ingestion_at") -> DataFrame:
    """Add the time of ingestion, one value per query."""
    return df.withColumn(col, F.current_timestamp())


def before(df: DataFrame, col: str, date: str) -> DataFrame:
    """Rows strictly before ``date``; NULLs drop out."""
    bound = day_bound(df.schema[col].dataType, F.lit(date).cast("date"))
    return df.where(F.col(col) < bound)


def trailing(df: DataFrame, col: str, date: str, months: int | None) -> DataFrame:
    """Rows in ``[date - months, date)``; ``months=None`` means all history."""
    rows = before(df, col, date)
    if months is None:
        return rows
    low = F.add_months(F.lit(date).cast("date"), -months)
    return rows.where(F.col(col) >= day_bound(df.schema[col].dataType, low))


def sorted_entity(df: DataFrame, keys: Sequence[str], spread: Sequence[str] = ()) -> DataFrame:
    """Globally sorted rows.

    A range partition cannot cut through equal keys, so a hot leading key would
    fill one task; ``spread`` names further columns that break those ties.
    """
    return df.orderBy(*keys, *spread)
