"""Dashboard questions over recommendations and events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftlab.functions import numeric


def _value() -> Column:
    return numeric.money_sum(F.col("expected_annual_value_usd"))


def _users() -> Column:
    return F.count(F.lit(1)).alias("users")


def mix(recs: DataFrame) -> DataFrame:
    """Users, average score and value per recommended product, highest value first."""
    return recs.groupBy("recommended_product").agg(
        _users(), numeric.mean(F.col("propensity_score"), 3).alias("avg_score"),
        numeric.round_half_up(_value()).alias("exp_value")).orderBy(F.desc("exp_value"), "recommended_product")


def in_order(report: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A report's rows in a fixed order, with the place of each; for tables of display size, as one task orders them."""
    place = F.row_number().over(Window.orderBy(*columns))
    return report.withColumn("position", place).orderBy("position")


def totals(recs: DataFrame) -> DataFrame:
    return recs.agg(_users(), _value().alias("exp_value"))


def top_product(product_mix: DataFrame) -> DataFrame:
    return product_mix.orderBy(F.desc("exp_value"), "recommended_product").limit(1)


def concentration(recs: DataFrame, top_deciles: int = 3) -> DataFrame:
    """Users and value inside and outside the targeted deciles, with their share of the value."""
    segment = F.when(F.col("targeting_decile") <= top_deciles, "targeted").otherwise("remaining")
    parts = recs.groupBy(segment.alias("segment")).agg(_users(), _value().alias("exp_value"))
    whole = F.round(F.sum("exp_value").over(Window.partitionBy(F.lit(0))), 2)  # two rows
    return parts.withColumn("share_pct", numeric.share_pct(F.col("exp_value"), whole))


def top_decile_value(recs: DataFrame, top_deciles: int) -> DataFrame:
    return recs.where(F.col("targeting_decile") <= top_deciles).agg(_users(), _value().alias("exp_value"))


def event_distribution(events: DataFrame) -> DataFrame:
    """Events per product and type; events without a product form a group of their own."""
    return events.groupBy("product", "event_type").agg(F.count(F.lit(1)).alias("events"))


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts side by side; a count over parquet reads no column."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
              for name, df in tables.items()]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def nudge_split(nudged: DataFrame) -> DataFrame:
    return nudged.groupBy("nudge_source").agg(_users())


def cohort_propensity(recs: DataFrame, dims: Sequence[str], product: str) -> DataFrame:
    """Average propensity for one product per cohort, best cohort first."""
    return recs.groupBy(*dims).agg(
        _users(), numeric.mean(F.col(f"prob_{product}"), 4).alias("avg_propensity"),
    ).orderBy(F.desc("avg_propensity"), *dims)


def _reached(steps: Sequence[str], counts: Mapping[str, Column], start: int) -> Column:
    """The step that a user who has done ``start`` steps has done after the events of one moment, each used once."""
    done = F.lit(len(steps))
    for step in range(len(steps) - 1, start - 1, -1):
        needed = list(steps[start:step + 1]).count(steps[step])
        done = F.when(counts[steps[step]] >= needed, done).otherwise(F.lit(step))
    return done


class _Path:
    """A part of a user's history as far as a funnel needs it, and how two parts make a longer one.

    ``began[j]``: the latest begin of a path inside the part that has done j steps in time; of two paths that have come as far,
    the one begun later can only last longer. ``done[i][j]``: when a path that came with i steps would have done j, which
    is in time if it began late enough. Both are enough to go on, so parts compose in any grouping.
    """

    def __init__(self, steps: int, within: str | None):
        self.steps, self.within = steps, within
        self.names = [f"began_{j}" for j in range(1, steps + 1)]
        self.names += [f"done_{i}_{j}" for i in range(1, steps) for j in range(i + 1, steps + 1)]

    def _in_time(self, moment: Column, began: Column) -> Column:
        return F.lit(True) if self.within is None else moment <= began + F.expr(f"INTERVAL {self.within}")

    def moment(self, reached: Sequence[Column]) -> Column:
        """All events at ``event_ts``; ``reached[i]`` is the step that i steps become there."""
        at = F.col("event_ts")
        return F.struct(*[
            F.when(reached[int(n.split("_")[1]) if n.startswith("done") else 0] >= int(n.split("_")[-1]), at).alias(n)
            for n in self.names])

    def then(self, a: Column, b: Column) -> Column:
        """Part ``a`` followed by part ``b``."""
        fields = []
        for j in range(1, self.steps + 1):
            longer = [F.when(b[f"done_{m}_{j}"].isNotNull() & self._in_time(b[f"done_{m}_{j}"], a[f"began_{m}"]), a[f"began_{m}"])
                      for m in range(1, j)]
            fields.append(F.greatest(a[f"began_{j}"], b[f"began_{j}"], *longer).alias(f"began_{j}"))
        for i in range(1, self.steps):
            for j in range(i + 1, self.steps + 1):
                # b goes on from the furthest step that a has reached
                rest = b[f"done_{i}_{j}"]
                for m in range(i + 1, j):
                    rest = F.when(a[f"done_{i}_{m}"].isNotNull(), b[f"done_{m}_{j}"]).otherwise(rest)
                fields.append(F.coalesce(a[f"done_{i}_{j}"], rest).alias(f"done_{i}_{j}"))
        return F.struct(*fields)

    def fold(self, parts: Column) -> Column:
        """An array of structs (place, path), composed in order of place."""
        in_order = F.array_sort(parts)
        return F.aggregate(F.slice(in_order, 2, F.size(in_order)), F.get(in_order, F.lit(0))["path"],
                           lambda so_far, next_part: self.then(so_far, next_part["path"]))


def funnel(events: DataFrame, steps: Sequence[str], product: str | None = None, within: str | None = None,
           bucket: str = "1 hour") -> DataFrame:
    """Users that do the steps in order, each by an event of its own at or after that of the step before.

    steps: event types; one may occur again. within: an interval such as '2 DAYS' in which a path has to end, counted
    from its first step; a user may begin anew at any time. One pass: events of one moment become counts per type, moments of
    one ``bucket`` and then buckets of one user become a path state, so a hot user's task sees one row per bucket.
    """
    seen = events if product is None else events.where(
        (F.col("product") == product) | F.col("product").isNull())
    kinds = list(dict.fromkeys(steps))
    moments = seen.where(F.col("event_type").isin(kinds)).where("user_id IS NOT NULL AND event_ts IS NOT NULL") \
        .groupBy("user_id", "event_ts").agg(*[
            F.count_if(F.col("event_type") == kind).alias(f"_n{n}") for n, kind in enumerate(kinds)])
    counts = {kind: F.col(f"_n{n}") for n, kind in enumerate(kinds)}
    path = _Path(len(steps), within)
    reached = [_reached(steps, counts, i) for i in range(len(steps))]
    parts = moments.select("user_id", F.window("event_ts", bucket).start.alias("_bucket"), F.struct(
        F.col("event_ts").alias("place"), path.moment(reached).alias("path")).alias("part"))
    per_bucket = parts.groupBy("user_id", "_bucket").agg(path.fold(F.collect_list("part")).alias("path"))
    per_user = per_bucket.groupBy("user_id").agg(
        path.fold(F.collect_list(F.struct(F.col("_bucket").alias("place"), "path"))).alias("path"))
    totals = per_user.agg(*[F.count(F.col(f"path.began_{j}")).alias(f"s{j}") for j in range(1, len(steps) + 1)])
    table = totals.select(F.inline(F.array(*[
        F.struct(F.lit(j).alias("step_no"), F.lit(step).alias("step"), F.col(f"s{j}").alias("users"), F.col("s1").alias("first"))
        for j, step in enumerate(steps, 1)])))
    return table.select("step_no", "step", "users", numeric.share_pct(F.col("users"), F.col("first")).alias("pct_of_first"))


def kpis(product_mix: DataFrame, lifts: DataFrame) -> DataFrame:
    """The headline figures as display text, one row each, from two small report tables."""
    thousands = numeric.round_half_up(F.sum("exp_value") / 1000.0).cast("long")
    best = F.max_by(F.col("recommended_product"), F.struct("exp_value", "recommended_product"))

    def shown(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("kpi"), value.alias("value"))

    offers = product_mix.agg(
        F.format_number(F.sum("users"), 0).alias("users"),
        F.concat(F.lit("$"), F.format_number(thousands, 0), F.lit("K")).alias("value"),
        F.initcap(best).alias("best"))
    offer_rows = offers.select(F.inline(F.array(
        shown("Users scored", F.col("users")), shown("Expected annual value", F.col("value")),
        shown("Top product", F.col("best")))))
    average = F.format_string("%+.1f pp", numeric.mean(F.col("lift_pp"), 1))
    return offer_rows.unionByName(lifts.agg(average.alias("value")).select(
        F.lit("Average lift").alias("kpi"), "value"))
