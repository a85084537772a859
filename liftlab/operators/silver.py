"""Bronze to silver: drop rows without keys, keep the newest delivery, type the columns.

Rules run before the de-duplication, so that their counters are true and rows with NULL keys
never travel to one hash partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlab.functions import numeric, timing
from liftlab.operators import dedup, quality

USER_RULES = {"valid_user": "user_id IS NOT NULL"}
EVENT_RULES = {"valid_event_id": "event_id IS NOT NULL", "valid_user": "user_id IS NOT NULL"}
ASSIGNMENT_RULES = {"valid_assignment": "experiment_id IS NOT NULL AND user_id IS NOT NULL"}

# Counted in a refresh, but the rows stay: a NULL takes the unreadable value's place.
EVENT_WARNINGS = {"readable_time": "event_ts IS NULL OR try_cast(event_ts AS TIMESTAMP_NTZ) IS NOT NULL",
                  "finite_amount": "amount_usd IS NULL OR abs(try_cast(amount_usd AS DOUBLE)) < double('Infinity')"}

ARRIVAL = ("_ingested_at", "_file_time", "_source_file")


def _newest(df: DataFrame, keys: Sequence[str], arrival: Sequence[str] | None) -> DataFrame:
    order = list(arrival) if arrival else [c for c in ARRIVAL if c in df.columns]
    return dedup.latest(df, keys, order)


def type_users(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "signup_date": timing.parse_date("signup_date"),
        "account_balance_usd": numeric.finite(F.col("account_balance_usd").try_cast("double")),
    })


def type_events(df: DataFrame, launch: str) -> DataFrame:
    typed = df.withColumns({
        "event_ts": timing.parse_timestamp("event_ts"),
        "amount_usd": numeric.finite(F.col("amount_usd").try_cast("double")),
    })
    return flag_launch(typed, launch)


def flag_launch(events: DataFrame, launch: str) -> DataFrame:
    return events.withColumn("is_post_launch", timing.is_post_launch(F.col("event_ts"), launch))


def type_assignments(df: DataFrame) -> DataFrame:
    return df.withColumn("assigned_ts", timing.parse_timestamp("assigned_ts"))


def users(bronze: DataFrame, arrival: Sequence[str] | None = None) -> DataFrame:
    return type_users(_newest(quality.expect_or_drop(bronze, USER_RULES), ["user_id"], arrival))


def events(bronze: DataFrame, launch: str, arrival: Sequence[str] | None = None) -> DataFrame:
    kept = _newest(quality.expect_or_drop(bronze, EVENT_RULES), ["event_id"], arrival)
    return type_events(kept, launch)


def assignments(bronze: DataFrame, arrival: Sequence[str] | None = None) -> DataFrame:
    kept = quality.expect_or_drop(bronze, ASSIGNMENT_RULES)
    return type_assignments(_newest(kept, ["experiment_id", "user_id"], arrival))
