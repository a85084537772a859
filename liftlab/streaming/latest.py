"""Latest-wins tables from streams: an upsert per micro-batch, with a log of what it changed.

A stream cannot take back what it has emitted, so the newest delivery of a key is kept in a versioned table instead.
A micro-batch rewrites only the buckets of the keys it brings, and becomes visible in one commit together with its
number and its log entries; a batch that is run again after a crash finds its number and does nothing. Deliveries
may come in any order: an older one never replaces a newer one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from liftlab import session
from liftlab.operators import dedup
from liftlab.sources import versions

_OLD = "_is_old"


@dataclass(frozen=True)
class LatestTable:
    """The newest row per key of a stream, and a log with the row before and after each change.

    newest_first: columns by which the newest delivery is told, such as a version number; remaining columns
    break ties, and of equal rows the one that is there stays, so a repeated delivery changes nothing.
    buckets: how finely the table is cut. A batch of many keys touches all of them, so choose it by the table's size.
    """

    store: versions.Versions
    name: str
    keys: tuple[str, ...]
    newest_first: tuple[str, ...]
    buckets: int = 64

    @property
    def _batch_note(self) -> str:
        return f"{self.name}.batch"

    def merge(self, batch: DataFrame, number: int) -> None:
        """One micro-batch, exactly once. Rows without a key are left out; drop or count them before."""
        before = self.store.snapshot()
        if before.notes.get(self._batch_note, -1) >= number:
            return
        keyed = batch.dropna(subset=list(self.keys))
        new = session.written(dedup.latest(keyed, self.keys, self.newest_first), "batch-latest")
        touched = sorted(r.b for r in new.select(
            versions.bucket_of(self.keys, self.buckets).alias("b")).distinct().collect())  # at most ``buckets``
        old = before.read(self.name, touched) if before.has(self.name) else new.limit(0)
        both = old.withColumn(_OLD, F.lit(1)).unionByName(new.withColumn(_OLD, F.lit(0)))
        winners = session.written(dedup.latest(both, self.keys, self.newest_first), "winners")
        was = old.select(*[F.col(k).alias(f"_{k}") for k in self.keys], F.struct("*").alias("before"))
        same_key = [F.col(k) == F.col(f"_{k}") for k in self.keys]
        changes = winners.where(f"{_OLD} = 0").drop(_OLD).join(was, same_key, "left").select(
            F.lit(number).cast("long").alias("batch"), F.when(F.col("before").isNull(), "insert").otherwise("update").alias("op"),
            *self.keys, "before", F.struct(*new.columns).alias("after"))
        self.store.commit(before.apply({
            self.name: self.store.bucketed(self.name, winners.drop(_OLD), self.keys, self.buckets, touched, before),
            f"{self.name}.changes": self.store.appended(f"{self.name}.changes", changes, before),
        }, **{self._batch_note: number}))

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Merge everything that is available, batch by batch, and stop."""
        return (stream.writeStream.foreachBatch(self.merge).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())

    def read(self) -> DataFrame:
        return self.store.snapshot().read(self.name)

    def changes(self, after: int = -1) -> DataFrame:
        """(batch, op, keys, before, after) of all batches later than ``after``, for consumers that keep up by themselves."""
        return self.store.snapshot().read(f"{self.name}.changes").where(F.col("batch") > after)
