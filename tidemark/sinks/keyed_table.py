"""A Parquet table of the latest row per key, fed by batches of changes.

Layout below ``path``::

    epoch-<n>/base/                  the table when the epoch began
    epoch-<n>/changes/<k>-<token>/   the rows of the k-th batch since

Applying a batch writes only that batch. Readers merge the batches of the newest
epoch into its base; ``compact`` begins a new epoch. Every write is one Spark job
into its own folder and counts from the moment its ``_SUCCESS`` marker is there.
One writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.dedup import latest_per_key, split_null_keys
from tidemark.operators.upsert import MODES, upsert
from tidemark.sinks.storage import matching, remove, size_of

ORDER = "_batch"


class KeyedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType | str,
        ids: Sequence[str],
        ts: str,
        mode: str = "last_write",
        tie: Sequence[str] = (),
        rejects: str | None = None,
    ) -> None:
        """``rejects``: a folder that rows without a complete key are appended to; without one they fail the batch."""
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if ORDER in {n.lower() for n in self.schema.names}:
            raise ValueError(f"the column name {ORDER} is taken")
        self.ids = list(ids)
        self.ts = ts
        self.mode = mode
        self.tie = list(tie)
        self.rejects = rejects

    def ensure(self) -> None:
        """Create the table with zero rows if it does not exist."""
        if self._epoch() is None:
            self.spark.createDataFrame([], self.schema).write.mode("overwrite").parquet(f"{self.path}/epoch-0/base")

    def apply(self, batch: DataFrame, token: str) -> None:
        """Upsert a batch: its latest row per key.

        ``token`` names the batch. One that this epoch or the one before holds
        completely is not applied again; an attempt that broke off is ignored
        and the batch gets the next number.
        """
        if not re.fullmatch(r"[\w.\-]+", token):
            raise ValueError(f"token {token!r} may hold only letters, digits and _ . -")
        epoch = self._epoch() or 0
        begun = [self._number(p) for p in matching(self.spark, f"{self.path}/epoch-{epoch}/changes/*")]
        done = [
            p for e in (epoch - 1, epoch) for p in matching(self.spark, f"{self.path}/epoch-{e}/changes/*-{token}/_SUCCESS")
        ]
        if any(re.search(rf"/\d+-{re.escape(token)}/_SUCCESS$", p) for p in done):
            return
        number = max(begun, default=0) + 1
        keyed = batch.select(*self.schema.names)
        message = f"batch {token}: rows with a NULL in the key {self.ids}"
        if self.rejects is not None:
            keyed, loose = split_null_keys(keyed, self.ids)
            loose.write.mode("overwrite").parquet(f"{self.rejects.rstrip('/')}/{token}")
        else:  # found while the batch is written: it is computed once
            keyed = keyed.withColumns(
                {c: F.coalesce(c, F.raise_error(F.lit(message)).cast(self.schema[c].dataType)) for c in self.ids}
            )
        latest = latest_per_key(keyed, self.ids, self.ts, self.tie).withColumn(ORDER, F.lit(number).cast("long"))
        try:
            latest.write.parquet(f"{self.path}/epoch-{epoch}/changes/{number}-{token}")
        except PySparkException as error:
            if message in str(error):
                raise ValueError(message) from error
            raise

    def read(self) -> DataFrame:
        """The current table."""
        epoch = self._epoch()
        if epoch is None:
            raise FileNotFoundError(f"no table at {self.path}")
        base = self.spark.read.schema(self.schema).parquet(f"{self.path}/epoch-{epoch}/base")
        pending = self._pending(epoch)
        if not pending:
            return base
        changes = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(ORDER, T.LongType())]))
        latest = changes.parquet(*pending)
        if len(pending) > 1:  # a batch holds each key once already
            order = [ORDER] if self.mode == "last_write" else [self.ts, ORDER]
            latest = latest_per_key(latest, self.ids, order)
        latest = latest.drop(ORDER)
        return latest if base.isEmpty() else upsert(base, latest, self.ids, self.mode, self.ts)

    def compact(self, above: float = 0.0) -> None:
        """Fold all applied batches into the base of a new epoch, if they hold over ``above`` times the base's bytes."""
        epoch = self._epoch()
        pending = [] if epoch is None else self._pending(epoch)
        if not pending:
            return
        base = size_of(self.spark, f"{self.path}/epoch-{epoch}/base")
        if not above or sum(size_of(self.spark, p) for p in pending) > above * base:
            self.read().write.mode("overwrite").parquet(f"{self.path}/epoch-{epoch + 1}/base")

    def vacuum(self) -> None:
        """Delete the epochs that neither readers nor a repeated batch need: all before the last but one."""
        epoch = self._epoch() or 0
        for found in matching(self.spark, f"{self.path}/epoch-*"):
            if int(found.rsplit("-", 1)[1]) < epoch - 1:
                remove(self.spark, found)

    def _epoch(self) -> int | None:
        found = matching(self.spark, f"{self.path}/epoch-*/base/_SUCCESS")
        return max((int(re.search(r"/epoch-(\d+)/base/", p)[1]) for p in found), default=None)

    def _pending(self, epoch: int) -> list[str]:
        found = matching(self.spark, f"{self.path}/epoch-{epoch}/changes/*/_SUCCESS")
        return [p.removesuffix("/_SUCCESS") for p in found]

    @staticmethod
    def _number(path: str) -> int:
        return int(re.search(r"/(\d+)-[^/]*$", path)[1])
