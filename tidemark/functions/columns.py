"""Column helpers. All of them compile to built-in expressions (no UDFs)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F, types as T

# Flags per packed long; the sign bit stays unused.
FLAGS_PER_WORD = 62


def decode(code: Column, labels: Mapping[int | str, str], default: str) -> Column:
    """Code to label; unknown and NULL codes both give ``default``."""
    out = F.lit(default)
    for value, label in reversed(list(labels.items())):
        out = F.when(code == F.lit(value), F.lit(label)).otherwise(out)
    return out


def epoch_text(seconds: Column) -> Column:
    """Epoch seconds to ``yyyy-MM-dd HH:mm:ss`` in the session zone."""
    return F.from_unixtime(seconds)


def epoch_timestamp(seconds: Column) -> Column:
    """Epoch seconds to a real timestamp, which Parquet filters can use."""
    return F.timestamp_seconds(seconds)


def day_bound(dtype: T.DataType, day: Column) -> Column:
    """Midnight of ``day`` in the type of the column it is compared with.

    Comparing like with like leaves the column bare, so the filter reaches the
    Parquet scan. ISO text sorts like the instants it denotes for four-digit
    years, hence text columns get a text bound.
    """
    if isinstance(dtype, T.StringType):
        return F.date_format(day, "yyyy-MM-dd")
    return day.cast(dtype)


def pack_flags(predicates: Sequence[str]) -> list[Column]:
    """Pack boolean SQL predicates into as few long words as hold them.

    A NULL predicate counts as false. ``bit_or`` of the words is the OR of the
    flags, so any number of conditional distinct counts needs one buffer per word.
    Each word is parsed from one text: building it call by call is much slower.
    """
    words = []
    for start in range(0, len(predicates), FLAGS_PER_WORD):
        chunk = predicates[start : start + FLAGS_PER_WORD]
        bits = [f"CASE WHEN {p} THEN {1 << bit}L ELSE 0L END" for bit, p in enumerate(chunk)]
        words.append(F.expr(" | ".join(bits)))
    return words


def unpack_flag(prefix: str, index: int) -> str:
    """SQL text for the 0/1 value of flag ``index``, from columns ``<prefix>0``, ``<prefix>1``, ..."""
    word, bit = divmod(index, FLAGS_PER_WORD)
    return f"(shiftright({prefix}{word}, {bit}) & 1L)"
