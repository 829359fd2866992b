"""Mixing of sources to target weights by iterative proportional fitting.

Documents are folded to cells (source, language, topic) with their tokens. Each
margin has target shares. A sweep scales the cells' weights so that they sum to
the targets of one margin after the other; sweeps go on until all margins fit.
The weights then give each cell a sampling probability, scaled so that a given
share of all tokens is expected; where it would exceed 1 it is 1, and the
rest is scaled up for it. A document is taken if the hash of its id and text,
read as a number from 0 to 1, is below the probability of its cell.

Only DataFrame functions are used. Sweeps run over the cells, never the
documents, and only totals of one row reach the driver.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import cut, fresh, join_counted

MARGINS = ("source", "lang", "topic")
# Targets by default: each share in proportion to tokens to this power.
FLATTEN = {"source": 0.5, "lang": 0.5, "topic": 0.7}
FRACTION = 0.5
# Raking ends after so many sweeps at the latest, with a warning if a margin is still off.
MAX_SWEEPS = 20
TOLERANCE = 1e-4
# Up to so many cells, their table is broadcast (about 100 bytes each).
BROADCAST_CELLS = 50_000

# Stems that speak for a topic; "general" is what none speaks for.
TOPICS = {
    "legal": ("licens", "copyright", "warrant"),
    "security": ("password", "passwd", "secret", "token", "api_key", "apikey"),
    "contact": ("@", "phone", "tel:"),
}
GENERAL = "general"


def _topic(text: Column, topics: Mapping[str, tuple[str, ...]]) -> Column:
    """The topic whose stems occur most often in the text, the first listed of equals."""
    low = F.lower(F.coalesce(text, F.lit("")))
    ranked = [F.struct(F.lit(0).alias("n"), F.lit(0).alias("order"), F.lit(GENERAL).alias("topic"))]
    for i, (name, stems) in enumerate(topics.items(), 1):
        # Occurrences by what is missing without them: no expression runs over the text.
        counts = [
            (F.octet_length(low) - F.octet_length(F.replace(low, F.lit(s)))) / len(s.encode()) for s in stems
        ]
        total = sum(counts[1:], counts[0]).cast("int")
        # Ranked behind "general" without any.
        order = F.when(total > 0, -i).otherwise(-len(topics) - i)
        ranked.append(F.struct(total.alias("n"), order.alias("order"), F.lit(name).alias("topic")))
    return F.greatest(*ranked)["topic"]


def _facts(docs: DataFrame, text_col: str, source_col: str, lang_col: str, topics, names: dict[str, str]) -> DataFrame:
    """``docs`` with the columns named in ``names``: the margins and tokens."""
    text = F.col(text_col).cast("string")
    tokens = F.regexp_count(text, F.lit(r"\S+"))
    return docs.withColumns(
        {
            names["source"]: F.coalesce(F.col(source_col).cast("string"), F.lit("")),
            names["lang"]: F.coalesce(F.col(lang_col).cast("string"), F.lit("")),
            names["topic"]: _topic(text, topics),
            names["tokens"]: F.coalesce(tokens, F.lit(0)).cast("long"),
        }
    )


def _few(df: DataFrame, values: int) -> DataFrame:
    """For the right side of a join: broadcast if it has few rows."""
    return F.broadcast(df) if values <= BROADCAST_CELLS else df


def _with_shares(cells: DataFrame, margin: str, given: Mapping[str, float] | None) -> tuple[DataFrame, int]:
    """``cells`` with the margin's target share, in sum 1 over the values that have tokens; how many values."""
    if given is None:
        raw = F.pow(F.col("tokens").cast("double"), F.lit(FLATTEN[margin]))
    else:
        raw = F.lit(0.0)
        for value, share in given.items():
            raw = F.when(F.col(margin) == value, F.lit(float(share))).otherwise(raw)
    raw = F.when(F.col("tokens") > 0, raw).otherwise(0.0)
    sums = cut(cells.groupBy(margin).agg(F.sum("tokens").alias("tokens")).select(margin, raw.alias("raw")))
    all_ = sums.agg(F.sum("raw").alias("raw"), F.count("*").alias("values")).first()
    shares = sums.select(margin, (F.col("raw") / F.lit(all_.raw or 1.0)).alias(f"_share_{margin}"))
    return cells.join(_few(shares, all_["values"]), margin), all_["values"]


def rake(
    cells: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    max_sweeps: int = MAX_SWEEPS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``cells`` (source, lang, topic, tokens, ...) with ``weight``: shares that fit the margins' targets.

    Stops when a sweep found no margin off by more than ``tolerance``, or after
    ``max_sweeps``, as where targets contradict each other or cells are missing;
    a warning then tells how far the worst margin is off.
    """
    columns = cells.columns
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    now, values = cells.withColumn("weight", F.col("tokens") / F.lit(total)), {}
    for m in MARGINS:
        now, values[m] = _with_shares(now, m, (targets or {}).get(m))
    now, worst = cut(now), 0.0
    for _ in range(max_sweeps):
        found = []
        for m in MARGINS:
            sums = now.groupBy(m).agg(F.sum("weight").alias("sum"), F.max(f"_share_{m}").alias("share"))
            found.append(
                cut(
                    sums.select(
                        m,
                        F.when(F.col("sum") > 0, F.col("share") / F.col("sum")).otherwise(0.0).alias("_factor"),
                        F.abs(F.col("sum") - F.col("share")).alias("off"),
                    )
                )
            )
            factors = _few(found[-1].select(m, "_factor"), values[m])
            now = now.join(factors, m).withColumn("weight", F.col("weight") * F.col("_factor")).drop("_factor")
        now = cut(now)
        off = found[0].select("off").unionAll(found[1].select("off")).unionAll(found[2].select("off"))
        worst = off.agg(F.max("off")).first()[0] or 0.0
        if worst <= tolerance:
            break
    if worst > tolerance:
        warnings.warn(f"raking ended after {max_sweeps} sweeps with a margin off by {worst:.2g}", stacklevel=2)
    return now.select(*columns, "weight")


def calibrate(cells: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """``cells`` with ``probability``: in proportion to weight per token, at most 1, for ``fraction`` of the tokens.

    Cells without tokens have probability 1. If the cells of any weight hold
    fewer tokens than asked for, all of theirs are taken.
    """
    sums = cells.agg(F.sum("tokens").alias("tokens"), F.sum("weight").alias("weight")).first()
    want = fraction * (sums.tokens or 0)
    scale, full = want / (sums.weight or 1.0), -1
    while True:
        # Cells at 1 give all their tokens; the others share what is left.
        capped = F.col("weight") * scale >= F.col("tokens")
        now = cells.where("weight > 0").agg(
            F.coalesce(F.sum(F.when(capped, 1)), F.lit(0)).alias("full"),
            F.sum(F.when(capped, F.col("tokens"))).alias("tokens"),
            F.sum(F.when(~capped, F.col("weight"))).alias("weight"),
        ).first()
        if now.full == full or not now.weight:
            break
        full, scale = now.full, (want - (now.tokens or 0)) / now.weight
    return cells.withColumn(
        "probability",
        F.when(F.col("tokens") == 0, 1.0).otherwise(F.least(F.lit(1.0), F.col("weight") * scale / F.col("tokens"))),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    targets: Mapping[str, Mapping[str, float]] | None = None,
    fraction: float = FRACTION,
    topics: Mapping[str, tuple[str, ...]] = TOPICS,
    seed: str = "mix",
    max_sweeps: int = MAX_SWEEPS,
) -> DataFrame:
    """``docs`` with all its columns and topic, tokens, weight, probability, sampled (named anew where taken).

    Tokens are words, cut at spaces and control characters 9 to 13. A topic is that of the stems the text has most of; null texts count as
    empty and have no tokens. Null sources and languages count as empty names.
    Values without a target, where targets are given, have share 0. Equal rows
    are taken or left together. An empty table gives an empty result.
    """
    names = {n: fresh(docs, f"_{n}") for n in (*MARGINS, "tokens")}
    rows = _facts(docs, text_col, source_col, lang_col, topics, names)
    cells = cut(
        rows.select(*[F.col(names[n]).alias(n) for n in names])
        .groupBy(*MARGINS)
        .agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    )
    odds = cut(calibrate(rake(cells, targets, max_sweeps), fraction))
    extra = {n: fresh(docs, n) for n in ("topic", "weight", "probability", "sampled")}
    count = fresh(docs, "_docs")
    known = odds.select(
        *[F.col(m).alias(names[m]) for m in MARGINS],
        F.col("weight").alias(extra["weight"]),
        F.col("probability").alias(extra["probability"]),
        F.col("docs").alias(count),
    )
    keys = [names[m] for m in MARGINS]
    if known.count() <= BROADCAST_CELLS:
        met = rows.join(F.broadcast(known), keys)
    else:
        met = join_counted(rows, known, keys, count, F.xxhash64(id_col, text_col))
    draw = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return met.select(
        *docs.columns,
        F.col(names["topic"]).alias(extra["topic"]),
        F.col(names["tokens"]).alias(fresh(docs, "tokens")),
        extra["weight"],
        extra["probability"],
        (draw < F.col(extra["probability"])).alias(extra["sampled"]),
    )


def mixed_sample(docs: DataFrame, **options) -> DataFrame:
    """The sampled documents of ``mix``."""
    found = mix(docs, **options)
    return found.where(F.col(found.columns[-1])).drop(found.columns[-1])
