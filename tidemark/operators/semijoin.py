"""Drop rows that will find no partner before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.skew import heavy_keys, salted_join

# Beyond this share of all keys most rows stay anyhow: no reduction.
LARGEST_SHARE = 0.5
# A filter holds so many keys at most: 2**25 bits, or 4 MB.
FILTER_KEYS = 1 << 22
_BITS_A_KEY = 8
_LEAST_BITS = 1 << 12


def shares(some: DataFrame, all_: DataFrame) -> tuple[int, int]:
    """(rows of ``some``, rows of ``all_``), by one job that reads no more columns than ``some`` filters on."""
    counts = some.agg(F.lit(0).alias("of"), F.count("*").alias("n")).unionAll(all_.agg(F.lit(1).alias("of"), F.count("*").alias("n")))
    found = {r.of: r.n for r in counts.collect()}
    return found[0], found[1]


def _place(key: Column, bits: int) -> tuple[Column, Column]:
    """(word, bit within the word) of a key's hash."""
    place = F.xxhash64(key).bitwiseAND(F.lit(bits - 1))
    return F.shiftright(place, 6).cast("int"), place.bitwiseAND(F.lit(63)).cast("int")


def key_filter(keys: DataFrame, key: str, count: int) -> Column:
    """Words of a bitmap with the hash of every key set, as a scalar subquery; ``count`` bounds the keys.

    A Bloom filter with one hash function: of keys that are not in it, at most
    one in ``_BITS_A_KEY`` passes. It is aggregated with a map-side part, and its
    size is bounded before it is built.
    """
    bits = filter_bits(count)
    word, bit = _place(F.col(key), bits)
    session = keys.sparkSession
    every = session.range(bits // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("set"))
    marked = keys.where(F.col(key).isNotNull()).select(
        word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("set")
    )
    words = marked.unionAll(every).groupBy("word").agg(F.bit_or("set").alias("set"))
    return words.agg(F.sort_array(F.collect_list(F.struct("word", "set"))).alias("w")).select(F.col("w.set")).scalar()


def filter_bits(count: int) -> int:
    if count > FILTER_KEYS:
        raise ValueError(f"a filter holds at most {FILTER_KEYS} keys, not {count}")
    return max(_LEAST_BITS, 1 << (count * _BITS_A_KEY - 1).bit_length() if count else 0)


def may_match(many: DataFrame, keys: DataFrame, key: str, count: int) -> DataFrame:
    """The rows of ``many`` whose ``key`` passes the filter of ``keys``: all that match, and few others."""
    word, bit = _place(F.col(key), filter_bits(count))
    filled = F.call_function("bit_get", F.get(key_filter(keys, key, count), word), bit)
    return many.where(F.col(key).isNotNull() & (filled == 1))


def reduced(many: DataFrame, keys: DataFrame, key: str, counts: tuple[int, int]) -> DataFrame:
    """``many`` with few of the rows, or none, whose ``key`` is not in ``keys``; ``keys`` may not repeat a key.

    ``counts`` are the keys and how many there are in all. A large share of them
    spares too little; a small number goes ahead as a filter inside the scan's
    own stage; many keys go ahead as a semi-join that splits hot keys, which
    shuffles ``many`` once to spare the shuffles after it.
    """
    some, all_ = counts
    if some > LARGEST_SHARE * all_:
        return many
    if some <= FILTER_KEYS and many.schema[key].dataType == keys.schema[key].dataType:
        return may_match(many, keys, key, some)
    rest = [c for c in many.columns if c != key]
    return salted_join(many, keys.select(key), key, rest, heavy_keys(many, key)).select(*many.columns)
