"""Time expressions. Event times carry no zone, so they are TIMESTAMP_NTZ throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(name: str) -> Column:
    """Text to a zone-less timestamp, NULL when unreadable."""
    return F.col(name).try_cast("timestamp_ntz")


def parse_date(name: str) -> Column:
    return F.col(name).try_cast("date")


def instant(iso: str) -> Column:
    return F.lit(iso).cast("timestamp_ntz")


def days_after(start: Column, days: int | Column) -> Column:
    return start + F.make_dt_interval(days if isinstance(days, Column) else F.lit(days))


def is_post_launch(ts: Column, launch: str) -> Column:
    """True from midnight of the launch day on; NULL stays NULL, so it is neither pre nor post."""
    return ts >= instant(launch)
