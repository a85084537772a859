"""Behaviour totals as states that add up: a delivery is counted once, and its events are never read again.

What makes a total mergeable is what is kept of it. Counts and sums are sums; the last activity is a maximum; active days
are a bitmap per (user, month), one bit per day in a long, which merges by OR; sessions are the set of their
names, as rows, since a session may have events in several deliveries. All of it merges exactly and in any order, with
map-side combine, so a hot user is a few partial rows per task.

A long per month is eight bytes; Spark's bitmap aggregates would make it four kilobytes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlab import session
from liftlab.functions import numeric
from liftlab.sources import versions


@dataclass(frozen=True)
class Totals:
    """months: (user_id, month, counts, deposits in cents, day bits, last activity); sessions: (user_id, session_id)."""

    months: DataFrame
    sessions: DataFrame


def state(events: DataFrame) -> Totals:
    """The state of one delivery: its events before launch, each of which no other delivery may hold."""
    before = events.where("NOT is_post_launch")
    day = F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth("event_ts") - 1)
    deposit = F.when(F.col("event_type") == "deposit", F.col("amount_usd"))
    months = before.groupBy("user_id", F.trunc("event_ts", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_type") == "trade").alias("trades"),
        F.count_if(F.col("event_type") == "login").alias("logins"),
        F.coalesce(F.sum(numeric.whole_steps(deposit, 100.0)), F.lit(0)).cast("decimal(38,0)").alias("cents"),
        F.bit_or(day).alias("days"), F.max("event_ts").alias("last_ts"))
    return Totals(months, before.where("session_id IS NOT NULL").select("user_id", "session_id").distinct())


def merge(*states: Totals) -> Totals:
    """The state of all deliveries together; states may be merged in any order and grouping."""
    months = reduce(DataFrame.unionByName, [s.months for s in states]).groupBy("user_id", "month").agg(
        *[F.sum(c).alias(c) for c in ("events", "trades", "logins")],
        F.sum("cents").cast("decimal(38,0)").alias("cents"), F.bit_or("days").alias("days"), F.max("last_ts").alias("last_ts"))
    return Totals(months, reduce(DataFrame.unionByName, [s.sessions for s in states]).distinct())


def totals(merged: Totals) -> DataFrame:
    """The columns of ``features.behavior``, from a merged state; both sides are hashed by user."""
    per_user = merged.months.groupBy("user_id").agg(
        F.sum("events").alias("events_total"), F.sum("trades").alias("trades_total"), F.sum("logins").alias("logins_total"),
        (F.sum("cents").cast("double") / 100.0).alias("deposit_total_usd"),
        F.sum(F.bit_count("days")).cast("long").alias("active_days"), F.max("last_ts").alias("last_activity_ts"))
    sessions = merged.sessions.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions_total"))
    return per_user.join(sessions, "user_id", "left").fillna(0, ["sessions_total"]).select(
        "user_id", "events_total", "trades_total", "logins_total", "deposit_total_usd", "sessions_total", "active_days",
        "last_activity_ts")


@dataclass(frozen=True)
class StoredTotals:
    """A state in a versioned table, cut by user. A delivery is merged into the buckets of its users only."""

    store: versions.Versions
    buckets: int = 64

    def absorb(self, events: DataFrame, delivery: str) -> bool:
        """Merge a delivery, exactly once by its name; False if it is in already."""
        before = self.store.snapshot()
        seen = before.notes.get("deliveries", [])
        if delivery in seen:
            return False
        new = state(events)
        parts = {"months": session.written(new.months, "delivery-months"),
                 "sessions": session.written(new.sessions, "delivery-sessions")}
        touched = sorted(r.b for r in parts["months"].select(
            versions.bucket_of(["user_id"], self.buckets).alias("b")).distinct().collect())  # at most ``buckets``
        own = Totals(**parts)
        merged = own if not before.version else merge(
            own, Totals(*[before.read(name, touched) for name in ("months", "sessions")]))
        self.store.commit(before.apply({
            name: self.store.bucketed(name, getattr(merged, name), ["user_id"], self.buckets, touched, before)
            for name in ("months", "sessions")}, deliveries=[*seen, delivery]))
        return True

    def totals(self) -> DataFrame:
        now = self.store.snapshot()
        return totals(Totals(now.read("months"), now.read("sessions")))
