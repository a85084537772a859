"""One row per user: behaviour before launch, adoption after launch, experiment variants.

Counts, sums, labels and active days come from one conditional aggregation. Its one distinct
count makes Catalyst aggregate in two steps, by (user, day) and then by user, both with map-side
combine: a user who holds a third of all events is spread over many tasks in the first step and
reduced to partial rows before the second. Sessions are counted the same way in a scan of two
columns. Two distinct counts in one aggregation would instead triple every event (an Expand);
on 20 million events that took twice as long as the second, narrow scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlab.functions import numeric, timing
from liftlab.operators import experiments
from liftlab.settings import CATALOG, Settings

# The published profile: no personal data (no email, no account number).
PROFILE = ("user_id", "signup_date", "tier", "region", "age_band", "risk_profile", "kyc_status",
           "account_balance_usd")
TOTALS = ("events_total", "trades_total", "logins_total", "deposit_total_usd", "sessions_total",
          "active_days")


_PRE = "NOT is_post_launch"


def _adopting(settings: Settings) -> str:
    """A trade after launch, inside the adoption window if there is one."""
    condition = "is_post_launch AND event_type = 'trade'"
    if settings.post_window_days is not None:
        end = f"TIMESTAMP_NTZ'{settings.launch}' + INTERVAL '{settings.post_window_days}' DAY"
        condition += f" AND event_ts < {end}"
    return condition


def _total_columns() -> list[Column]:
    deposit = F.expr(f"CASE WHEN {_PRE} AND event_type = 'deposit' THEN amount_usd END")
    return [
        F.expr(f"count_if({_PRE}) AS events_total"),
        F.expr(f"count_if({_PRE} AND event_type = 'trade') AS trades_total"),
        F.expr(f"count_if({_PRE} AND event_type = 'login') AS logins_total"),
        F.coalesce(numeric.money_sum(deposit), F.lit(0.0)).alias("deposit_total_usd"),
        F.expr(f"count(DISTINCT CASE WHEN {_PRE} THEN CAST(event_ts AS DATE) END) AS active_days"),
        F.expr(f"max(CASE WHEN {_PRE} THEN event_ts END) AS last_activity_ts"),
    ]


def _affinity_columns(products: Sequence[str]) -> list[Column]:
    return [F.expr(f"count_if({_PRE} AND product = '{p}') AS pre_{p}_interactions") for p in products]


def _label_columns(settings: Settings) -> list[Column]:
    bought = _adopting(settings)
    seen = f"count_if({_PRE}) > 0" if settings.labels_require_pre_activity else "true"
    return [
        F.expr(f"IF({seen}, max(IF({bought} AND product = '{p}', 1, 0)), 0) AS adopted_{p}")
        for p in settings.products]


def _with_sessions(per_user: DataFrame, events: DataFrame) -> DataFrame:
    """Adds the distinct sessions before launch; both sides are unique and hashed by user_id."""
    sessions = events.where(_PRE).groupBy("user_id").agg(
        F.countDistinct("session_id").alias("sessions_total"))
    return fill_zero(per_user.join(sessions, "user_id", "left"), ["sessions_total"])


def behavior(events: DataFrame) -> DataFrame:
    """Totals before launch; users without such events are absent."""
    return _with_sessions(events.where(_PRE).groupBy("user_id").agg(*_total_columns()), events)


def affinity(events: DataFrame, products: Sequence[str]) -> DataFrame:
    """Interactions of any type before launch, per product."""
    return events.where(_PRE).groupBy("user_id").agg(*_affinity_columns(products))


def labels(events: DataFrame, settings: Settings) -> DataFrame:
    """adopted_{p} per user with any event: at least one trade of p after launch."""
    return events.groupBy("user_id").agg(*_label_columns(settings))


def activity(events: DataFrame, settings: Settings) -> DataFrame:
    """Totals, affinity and labels together."""
    products = ", ".join(f"'{p}'" for p in settings.products)
    needed = f"({_PRE}) OR ({_adopting(settings)} AND product IN ({products}))"
    per_user = events.where(needed).groupBy("user_id").agg(
        *_total_columns(), *_affinity_columns(settings.products), *_label_columns(settings))
    return _with_sessions(per_user, events)


def tenure(users: DataFrame, launch: str) -> DataFrame:
    """Days from signup to launch; negative for a signup after launch."""
    return users.withColumn(
        "tenure_days", F.datediff(F.lit(launch).cast("date"), F.col("signup_date")))


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(columns))


def user_features(users: DataFrame, events: DataFrame, assignments: DataFrame,
                  settings: Settings) -> DataFrame:
    """Every user once. All three sides are unique per user_id and hashed by it."""
    products = settings.products
    joined = (
        tenure(users.select(*PROFILE), settings.launch)
        .join(activity(events, settings), "user_id", "left")
        .join(experiments.variant_matrix(assignments, products), "user_id", "left")
    )
    counted = [*TOTALS, *(f"pre_{p}_interactions" for p in products),
               *(f"adopted_{p}" for p in products)]
    return fill_zero(joined, counted).select(
        *PROFILE, "tenure_days", *TOTALS, "last_activity_ts",
        *(f"pre_{p}_interactions" for p in products), *(f"adopted_{p}" for p in products),
        *(f"variant_{p}" for p in products))


def trailing(events: DataFrame, as_of: str, days: int) -> DataFrame:
    """Activity in the ``days`` before ``as_of``: trades, deposits per day, events per session,
    and all products traded, those of the catalog first and in its order, others by name."""
    until = timing.instant(as_of)
    recent = (F.col("event_ts") < until) & (F.col("event_ts") >= timing.days_after(until, -days))
    trade = F.col("event_type") == "trade"
    known = F.array(*[F.lit(row[0]) for row in CATALOG])
    # a set of products, so at most as long as the list of all products
    held = F.array_sort(F.transform(F.collect_set(F.when(trade, F.col("product"))), lambda p: F.struct(
        F.coalesce(F.nullif(F.array_position(known, p), F.lit(0)), F.lit(len(CATALOG) + 1)).alias("at"), p.alias("p"))))
    deposits = F.coalesce(
        numeric.money_sum(F.when(F.col("event_type") == "deposit", F.col("amount_usd"))), F.lit(0.0))
    sessions = F.countDistinct("session_id")
    return events.where(recent).groupBy("user_id").agg(
        F.count_if(trade).alias(f"trades_{days}d"),
        numeric.round_half_up(deposits / F.lit(float(days)), 4).alias("deposit_per_day_usd"),
        numeric.round_half_up(F.count(F.lit(1)) / F.when(sessions > 0, sessions), 4)
        .alias("events_per_session"),
        F.concat_ws(",", held["p"]).alias("product_holdings"),
    )
