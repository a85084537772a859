"""Files to gold, run by run: only what the new rows touch is read and written again.

Silver and gold are cut into buckets by user. A run takes the micro-batches that no earlier run has merged, finds the
users that they touch and the buckets of these users, and writes only these buckets anew; within them the gold rows
of all other users are copied as they are. Everything a run makes becomes visible in one commit, together with the
numbers of the batches it merged: a run that is lost leaves the last version as it was, and the next run merges the
same batches. The result equals that of a whole rebuild over all deliveries.

An event is found again by its id, which says nothing about the user it was delivered for before. ``silver/event_users``,
cut by event, keeps every user an event was delivered for, so that a correction that moves an event to another user takes
it away from the first.

New rows are one per key before they are merged. So a table without a past takes them as they are, and stored rows are
brought together with a few new ones by a broadcast of the new keys; only many new keys shuffle the touched buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import asdict
from functools import reduce
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlab import session
from liftlab.operators import dedup, experiments, features, privacy, quality, silver
from liftlab.plans.medallion import CATALOG_RULES, READABLE, Feeds, Layers
from liftlab.settings import Settings
from liftlab.sources import files, versions
from liftlab.streaming import ingest

BUCKETS = 64
#: Most new rows whose keys are sent to the stored rows; above it both sides are shuffled by key. Results are the same.
FEW_ROWS = 500_000


class Run:
    """One incremental run. ``now`` is what the next version will be; nothing is visible before the commit."""

    def __init__(self, spark: SparkSession, feeds: Feeds, base: str, settings: Settings, buckets: int = BUCKETS):
        self.spark, self.feeds, self.base, self.settings, self.buckets = spark, feeds, base, settings, buckets
        self.store = versions.Versions(spark, f"{base}/tables")
        last = self.store.snapshot()
        setup = {**asdict(settings), "products": list(settings.products), "buckets": buckets}
        if last.version and last.notes["setup"] != setup:
            # other settings change every row: merge all batches again, into tables without a past
            last = versions.Snapshot(spark, last.version, {}, {})
        self.before = self.now = last.apply({}, setup=setup)
        self.merged: dict[str, int] = dict(last.notes.get("batches", {}))
        self._lock = Lock()  # feeds are merged side by side

    # ------------------------------------------------------------ helpers
    def _rules(self, feed: ingest.Feed) -> quality.Rules:
        own = {self.feeds.users.name: silver.USER_RULES, self.feeds.events.name: silver.EVENT_RULES,
               self.feeds.assignments.name: silver.ASSIGNMENT_RULES}.get(feed.name, CATALOG_RULES)
        return {**(READABLE if feed.fmt != "parquet" else {}), **own}

    def _counted(self, feed: ingest.Feed) -> quality.Rules:
        return {**self._rules(feed), **(silver.EVENT_WARNINGS if feed == self.feeds.events else {})}

    def _stage(self, name: str, table: versions.Table) -> None:
        with self._lock:
            self.now = self.now.apply({name: table})

    def _touched(self, rows: DataFrame, key: str) -> list[int]:
        """Buckets with a row; at most ``buckets`` numbers come to the driver."""
        found = rows.select(versions.bucket_of([key], self.buckets).alias("b")).distinct()
        return sorted(r.b for r in found.collect())

    def _old(self, name: str, like: DataFrame, buckets: list[int]) -> DataFrame:
        if self.before.has(name):
            return self.before.read(name, buckets)
        return self.spark.createDataFrame([], like.schema)

    def _bucketed(self, name: str, rows: DataFrame, key: str, touched: list[int]) -> DataFrame:
        """Stage the touched buckets of a table; returns them."""
        self._stage(name, self.store.bucketed(name, rows, [key], self.buckets, touched, self.before))
        return self.now.read(name, touched)

    def _upsert(self, name: str, changed: DataFrame, keys: list[str], bucket_key: str, touched: list[int]) -> DataFrame:
        """Merge new rows, one per key, into the touched buckets; of a stored and a new row of one key the later arrival stays."""
        merged = changed
        if self.before.has(name):
            merged = self._merged(self.before.read(name, touched), changed, keys,
                                  lambda rows: dedup.latest(rows, keys, list(silver.ARRIVAL)))
        return self._bucketed(name, merged, bucket_key, touched)

    @staticmethod
    def _merged(old: DataFrame, changed: DataFrame, keys: list[str], reduced: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``reduced`` over old and new rows; old rows that share no key with a new one are reduced already."""
        if changed.count() > FEW_ROWS:
            return reduced(old.unionByName(changed))
        new = F.broadcast(changed.select(*keys))
        met = old.join(new, keys, "left_semi").select(*old.columns).unionByName(changed)
        return old.join(new, keys, "left_anti").select(*old.columns).unionByName(reduced(met))

    # ------------------------------------------------------------ steps
    def ingest(self) -> None:
        for query in [ingest.to_batches(self.spark, feed, self.base, self._counted(feed)) for feed in self.feeds.all()]:
            query.awaitTermination()

    def new_rows(self, feed: ingest.Feed) -> DataFrame | None:
        """The valid rows of all batches that no version holds, None if there are none; rows that fail go to quarantine."""
        numbers = ingest.batch_numbers(self.spark, self.base, feed.name, self.merged.get(feed.name, -1))
        name = f"quarantine/{feed.name}"
        if not numbers and self.before.has(name):
            return None
        good, bad = quality.split(ingest.batches(self.spark, self.base, feed, numbers), self._rules(feed))
        self._stage(name, self.store.appended(name, bad, self.before))
        if numbers:
            self.merged[feed.name] = numbers[-1]
        return good.drop(files.CORRUPT)

    def merge_users(self) -> DataFrame | None:
        """Users whose profile changed; also stages the masked table."""
        new = self.new_rows(self.feeds.users)
        if new is None:
            return None
        changed = session.written(silver.users(new), "changed-users")
        touched = self._touched(changed, "user_id")
        rows = self._upsert("silver/users", changed, ["user_id"], "user_id", touched)
        self._bucketed("gold/users_secure", privacy.secure_view(rows), "user_id", touched)
        return changed.select("user_id")

    def merge_assignments(self) -> DataFrame | None:
        new = self.new_rows(self.feeds.assignments)
        if new is None:
            return None
        changed = session.written(silver.assignments(new), "changed-assignments")
        self._upsert("silver/assignments", changed, ["experiment_id", "user_id"], "user_id",
                     self._touched(changed, "user_id"))
        return changed.select("user_id")

    def merge_events(self) -> DataFrame | None:
        """Users that have gained, lost or changed an event."""
        new = self.new_rows(self.feeds.events)
        if new is None:
            return None
        changed = session.written(silver.events(new, self.settings.launch), "changed-events")
        pairs = changed.select("event_id", "user_id")
        home = self._touched(changed, "event_id")
        touched, known = changed.select("user_id"), pairs
        if self.before.has("silver/event_users"):
            stored = self.before.read("silver/event_users", home)
            touched = touched.union(stored.join(changed.select("event_id"), "event_id", "left_semi").select("user_id"))
            known = self._merged(stored, pairs, ["event_id"], DataFrame.distinct)
        users = session.written(touched.distinct(), "event-users")
        self._upsert("silver/events", changed, ["event_id"], "user_id", self._touched(users, "user_id"))
        self._bucketed("silver/event_users", known, "event_id", home)
        return users

    def merge_catalog(self) -> None:
        changed = None if self.feeds.catalog is None else self.new_rows(self.feeds.catalog)
        if changed is not None:
            everything = self._old("silver/catalog", changed, [0]).unionByName(changed)
            self._stage("silver/catalog", self.store.bucketed(
                "silver/catalog", dedup.latest(everything, ["product"], silver.ARRIVAL), ["product"], 1, [0], self.before))

    def build_gold(self, touched_users: DataFrame) -> None:
        """Feature rows of the touched users, and what they add to the experiments' counts."""
        users = session.written(touched_users.distinct(), "touched-users")
        buckets = self._touched(users, "user_id")
        parts = [self.now.read(f"silver/{n}", buckets) for n in ("users", "events", "assignments")]
        if not self.before.has("gold/user_features"):
            # nothing is older than this run, so its users are all there are
            counted = [experiments.counts(self._bucketed(
                "gold/user_features", features.user_features(*parts, self.settings), "user_id", buckets), self.settings)]
        else:
            mine = [part.join(users, "user_id", "left_semi") for part in parts]
            fresh = session.written(features.user_features(*mine, self.settings), "fresh-features")
            old = self.before.read("gold/user_features", buckets)
            self._bucketed("gold/user_features", old.join(users, "user_id", "left_anti").unionByName(fresh), "user_id", buckets)
            counted = [experiments.counts(fresh, self.settings),
                       experiments.counts(old.join(users, "user_id", "left_semi"), self.settings).selectExpr(
                           "product", "variant", "-users AS users", "-adopters AS adopters"),
                       self.before.read("gold/experiment_counts")]
        total = counted[0]
        for more in counted[1:]:
            total = total.unionByName(more)
        total = total.groupBy("product", "variant").agg(F.sum("users").alias("users"), F.sum("adopters").alias("adopters"))
        self._stage("gold/experiment_counts", self.store.whole("gold/experiment_counts", total.where("users > 0").coalesce(1)))
        counts = self.now.read("gold/experiment_counts")
        self._stage("gold/experiment_results", self.store.whole(
            "gold/experiment_results", experiments.rates(counts, self.settings).coalesce(1)))

    def merge(self) -> versions.Snapshot:
        """All new batches into silver and gold, in one commit; without new batches the version stays."""
        steps = [self.merge_users, self.merge_assignments, self.merge_events, self.merge_catalog]
        with ThreadPool(len(steps)) as pool:
            found = pool.map(inheritable_thread_target(self.spark)(lambda step: step()), steps)
        touched = [users for users in found if users is not None]
        if self.merged == self.before.notes.get("batches"):
            return self.before
        if touched:
            self.build_gold(reduce(DataFrame.union, touched))
        counts = ingest.rule_counts(self.spark, self.base, self.feeds.all())
        self._stage("quality/rule_counts", self.store.whole("quality/rule_counts", counts.coalesce(1)))
        self.now = self.now.apply({}, batches=self.merged)
        return self.store.commit(self.now)


def layers(snapshot: versions.Snapshot, feeds: Feeds) -> Layers:
    """The tables of one version."""
    quarantine: Mapping[str, DataFrame] = {f.name: snapshot.read(f"quarantine/{f.name}") for f in feeds.all()}
    return Layers(
        *(snapshot.read(f"silver/{n}") for n in ("users", "events", "assignments")),
        *(snapshot.read(f"gold/{n}") for n in ("user_features", "experiment_results", "users_secure")),
        snapshot.read("quality/rule_counts"), quarantine,
        snapshot.read("silver/catalog") if snapshot.has("silver/catalog") else None)


def refresh(spark: SparkSession, feeds: Feeds, base: str, settings: Settings, buckets: int = BUCKETS,
            keep: int = 2) -> Layers:
    """Ingest what is new, merge it and return the tables, pinned to the new version.

    buckets: how finely the tables are cut; a table keeps the number it was made with. A run rewrites at most the
    buckets of touched users, so choose it for files of about 100 MB or more. keep: versions that stay readable.
    Other settings than those of the last run rebuild everything from bronze. One run at a time may commit; a
    second one that started from the same version fails with ``versions.Conflict`` and can be run again.
    """
    run = Run(spark, feeds, base, settings, buckets)
    run.ingest()
    snapshot = run.merge()
    run.store.vacuum(keep)
    return layers(snapshot, feeds)
