"""Experiment read-outs: variants per user, adoption per variant, lift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftlab.functions import numeric, timing
from liftlab.settings import Settings


def variant_matrix(assignments: DataFrame, products: Sequence[str]) -> DataFrame:
    """Long to wide: one variant column per product. max() makes the pick independent of order."""
    return assignments.groupBy("user_id").agg(*[
        F.max(F.when(F.col("product") == p, F.col("variant"))).alias(f"variant_{p}")
        for p in products
    ])


def conflicting_assignments(assignments: DataFrame) -> DataFrame:
    """(product, user) pairs that were given more than one variant."""
    return (assignments.groupBy("product", "user_id")
            .agg(F.min("variant").alias("first_variant"), F.max("variant").alias("last_variant"))
            .where("first_variant <> last_variant"))


def by_product(features: DataFrame, products: Sequence[str], keep: Sequence[str] = (),
               **prefixes: str) -> DataFrame:
    """Wide to long: one row per user and product; ``name=prefix`` reads column prefix_{p}."""
    rows = F.array(*[
        F.struct(F.lit(p).alias("product"),
                 *[F.col(pattern.format(p)).alias(name) for name, pattern in prefixes.items()])
        for p in products
    ])
    return features.select(*keep, F.inline(rows))


def _experiment_id(settings: Settings) -> Column:
    before, after = settings.experiment_id.split("{product}")
    return F.concat(F.lit(before), F.col("product"), F.lit(after))


def counts(features: DataFrame, settings: Settings) -> DataFrame:
    """(product, variant, users, adopters): one scan, one aggregation; counts of disjoint users add up."""
    long = by_product(features, settings.products, variant="variant_{}", adopted="adopted_{}")
    return long.where("variant IS NOT NULL").groupBy("product", "variant").agg(
        F.count(F.lit(1)).alias("users"), F.sum("adopted").alias("adopters"))


def rates(counted: DataFrame, settings: Settings) -> DataFrame:
    return counted.select(
        _experiment_id(settings).alias("experiment_id"), "product", "variant", "users", "adopters",
        numeric.share_pct(F.col("adopters"), F.col("users")).alias("adoption_rate_pct"))


def results(features: DataFrame, settings: Settings) -> DataFrame:
    """Users, adopters and adoption rate per product and variant."""
    return rates(counts(features, settings), settings)


def _rate_of(variant: str) -> Column:
    return F.max(F.when(F.col("variant") == variant, F.col("adoption_rate_pct")))


def lift_table(experiment_results: DataFrame) -> DataFrame:
    """Control rate, treatment rate and their difference in percentage points, per product."""
    wide = experiment_results.groupBy("product").agg(
        _rate_of("control").alias("control_pct"), _rate_of("treatment").alias("treatment_pct"))
    lift = numeric.round_half_up(F.col("treatment_pct") - F.col("control_pct"), 2)
    return wide.withColumn("lift_pp", lift)


def lift(experiment_results: DataFrame) -> DataFrame:
    return (lift_table(experiment_results).select("product", "lift_pp")
            .orderBy(F.desc("lift_pp"), "product"))


def average_lift(lifts: DataFrame) -> DataFrame:
    return lifts.agg(numeric.mean(F.col("lift_pp"), 4).alias("avg_lift_pp"))


def best_variant(experiment_results: DataFrame) -> DataFrame:
    """The variant with the highest rate per product; the name breaks ties."""
    best = F.max_by(F.col("variant"), F.struct("adoption_rate_pct", "variant"))
    return experiment_results.groupBy("product").agg(
        best.alias("best_variant"), F.max("adoption_rate_pct").alias("adoption_rate_pct"))


def adopter_check(events: DataFrame, features: DataFrame, products: Sequence[str]) -> DataFrame:
    """Adopters counted from events beside adopters in the feature table; they must agree."""
    from_events = (
        events.where(F.col("is_post_launch") & (F.col("event_type") == "trade")
                     & F.col("product").isin(*products))
        .groupBy("product").agg(F.countDistinct("user_id").alias("adopters"))
    )
    in_features = by_product(features, products, adopted="adopted_{}").groupBy("product").agg(
        F.count(F.lit(1)).alias("users"), F.sum("adopted").alias("feature_adopters"))
    return in_features.join(from_events, "product", "left").select(
        "product", F.coalesce("adopters", F.lit(0)).alias("adopters"), "feature_adopters",
        numeric.share_pct(F.coalesce("adopters", F.lit(0)), F.col("users")).alias("pct_of_users"))


def base_rates(features: DataFrame, products: Sequence[str]) -> DataFrame:
    return by_product(features, products, adopted="adopted_{}").groupBy("product").agg(
        numeric.round_half_up(F.sum("adopted") / F.count(F.lit(1)), 6).alias("base_rate"))


def exposed_events(events: DataFrame, assignments: DataFrame, days: int) -> DataFrame:
    """Events on a product within ``days`` after the user was assigned to its experiment.

    The range condition rides on the (user, product) equi-join. Assignments are unique per
    pair, so the join adds no rows; a hot user's events are split by the adaptive skew join.
    """
    assigned = assignments.select("user_id", "product", "experiment_id", "variant", "assigned_ts")
    ts, start = F.col("event_ts"), F.col("assigned_ts")
    return (
        events.where(F.col("product").isNotNull())
        .join(assigned, ["user_id", "product"])
        .where((ts >= start) & (ts < timing.days_after(start, days)))
        .select("event_id", "user_id", "event_ts", "event_type", "product", "experiment_id", "variant")
    )


def asof_exposure(events: DataFrame, assignments: DataFrame, days: int, width: str = "1 day") -> DataFrame:
    """Each event on a product with the assignment in force: the newest one at or before it, if within ``days``.

    A user may be assigned again, to another variant or another experiment of the same product; each event still
    counts once. Of assignments at the same time the last by (experiment, variant) is in force. Events and assignments without
    user, product or time are left out.

    Events and assignments are ordered together within (user, product, time bucket). What is in force when a bucket begins
    comes from one row per bucket and key, so neither a user's events nor assignments have to meet in one task, but
    for those of one bucket of ``width``.
    """
    keys = ["user_id", "product"]
    known = "user_id IS NOT NULL AND product IS NOT NULL"
    bucket = F.window("at", width).start.alias("_bucket")
    in_force = F.struct("assigned_ts", "experiment_id", "variant")
    seen = events.where(known).where("event_ts IS NOT NULL").select(
        *keys, F.col("event_ts").alias("at"), F.struct("event_id", "event_type").alias("event")).select("*", bucket)
    given = assignments.where(known).where("assigned_ts IS NOT NULL").select(
        *keys, F.col("assigned_ts").alias("at"), in_force.alias("given")).select("*", bucket)

    nothing = F.lit(None)
    busy = seen.groupBy(*keys, "_bucket").agg(F.lit(True).alias("busy"))
    per_bucket = given.groupBy(*keys, "_bucket").agg(F.max("given").alias("given"))
    timeline = busy.join(per_bucket, [*keys, "_bucket"], "full")
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = timeline.withColumn("given", F.last("given", ignorenulls=True).over(earlier)).where("busy AND given IS NOT NULL")

    kind = given.schema["given"].dataType
    rows = seen.select(*keys, "_bucket", "at", F.lit(2).alias("kind"), nothing.cast(kind).alias("given"), "event").unionByName(
        given.select(*keys, "_bucket", "at", F.lit(1).alias("kind"), "given"), allowMissingColumns=True).unionByName(
        carried.select(*keys, "_bucket", F.col("_bucket").cast(seen.schema["at"].dataType).alias("at"),
                       F.lit(0).alias("kind"), "given"), allowMissingColumns=True)
    in_order = Window.partitionBy(*keys, "_bucket").orderBy("at", "kind", "given").rowsBetween(Window.unboundedPreceding, 0)
    matched = rows.withColumn("given", F.last("given", ignorenulls=True).over(in_order)).where("kind = 2 AND given IS NOT NULL")
    return matched.where(F.col("at") < timing.days_after(F.col("given.assigned_ts"), days)).select(
        "event.event_id", "user_id", F.col("at").alias("event_ts"), "event.event_type", "product", "given.experiment_id",
        "given.variant", "given.assigned_ts")
