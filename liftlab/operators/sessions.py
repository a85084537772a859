"""Sessions by inactivity gap.

Two events in the same gap-wide time bucket are always in the same session. Events are
therefore first reduced to one row per (user, bucket), with map-side combine, and only those
rows are ordered per user. A user with a third of all events is left with at most
(covered time / gap) rows, whatever the number of events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def by_gap(events: DataFrame, gap_seconds: int) -> DataFrame:
    """One row per session; a pause of ``gap_seconds`` or more starts a new one."""
    gap = f"{gap_seconds} seconds"
    busy = (
        events.where(F.col("event_ts").isNotNull() & F.col("user_id").isNotNull())
        .groupBy("user_id", F.window("event_ts", gap).start.alias("_bucket"))
        .agg(F.min("event_ts").alias("first_ts"), F.max("event_ts").alias("last_ts"),
             F.count(F.lit(1)).alias("events"))
    )
    in_order = Window.partitionBy("user_id").orderBy("_bucket")
    deadline = F.lag("last_ts").over(in_order) + F.expr(f"INTERVAL {gap}")
    marked = busy.withColumn("_new", F.when(F.col("first_ts") >= deadline, 1).otherwise(0))
    numbered = marked.withColumn(
        "session_no", (F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) + 1))
    return numbered.groupBy("user_id", "session_no").agg(
        F.min("first_ts").alias("session_start"), F.max("last_ts").alias("session_end"),
        F.sum("events").alias("events"))


def stream_by_gap(events: DataFrame, gap: str, delay: str) -> DataFrame:
    """The streaming form: closed sessions only, in append mode, behind a watermark."""
    return (
        events.withWatermark("event_ts", delay)
        .groupBy("user_id", F.session_window("event_ts", gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("events"), F.max("event_ts").alias("session_end"))
        .select("user_id", F.col("w.start").alias("session_start"), "session_end", "events")
    )


def open_tail(events: DataFrame, closed: DataFrame, gap_seconds: int) -> DataFrame:
    """Sessions that a stream has not closed yet: those of the events after each user's last
    closed one. Together with ``closed`` they are all sessions of ``events``."""
    done = closed.groupBy("user_id").agg(F.max("session_end").alias("_done"))
    rest = events.join(done, "user_id", "left").where("_done IS NULL OR event_ts > _done")
    return by_gap(rest.drop("_done"), gap_seconds).drop("session_no")
