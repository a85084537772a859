"""From per-product propensities to one recommendation per user."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlab.functions import numeric
from liftlab.operators import rank
from liftlab.settings import Settings


def _prob(product: str) -> Column:
    return numeric.no_nan(F.col(f"prob_{product}"))


def assemble(scores: DataFrame, products: Sequence[str]) -> DataFrame:
    """Best product and its propensity; the first product in order wins a tie."""
    probs = [_prob(p) for p in products]
    best = F.greatest(*probs) if len(probs) > 1 else probs[0]
    pick = F.coalesce(*[F.when(prob == best, F.lit(p)) for p, prob in zip(products, probs)])
    return scores.withColumns({"recommended_product": pick, "propensity_score": best})


def top_products(scores: DataFrame, products: Sequence[str], k: int) -> DataFrame:
    """The k best products per user in one row per (user, place); p is fixed, so is the array."""
    entries = F.array(*[
        F.struct((-F.coalesce(_prob(p), F.lit(-1.0))).alias("sort_key"), F.lit(i).alias("place"),
                 F.lit(p).alias("product"), _prob(p).alias("prob"))
        for i, p in enumerate(products)
    ])
    best = F.slice(F.sort_array(entries), 1, k)
    return (scores.select("user_id", F.posexplode(best).alias("pos", "entry"))
            .select("user_id", (F.col("pos") + 1).alias("place"), F.col("entry.product").alias("product"),
                    F.col("entry.prob").alias("prob"))
            .where("prob IS NOT NULL"))


def fees(catalog: DataFrame, products: Sequence[str]) -> DataFrame:
    """One fee per configured product: never more rows than ``products`` has entries."""
    return (catalog.where(F.col("product").isin(*products))
            .groupBy("product").agg(F.max("fee_bps").alias("fee_bps")))


def expected_value(recs: DataFrame, catalog: DataFrame, settings: Settings) -> DataFrame:
    """propensity x notional x fee. The join key has a handful of values, so the fee side is
    broadcast (bounded by ``fees``); hashing users by product would make a few giant tasks."""
    value = (F.col("propensity_score") * F.lit(settings.notional_usd)
             * (F.col("fee_bps") / F.lit(10000.0)))
    return (
        recs.join(F.broadcast(fees(catalog, settings.products)),
                  F.col("recommended_product") == F.col("product"), "left")
        .withColumn("expected_annual_value_usd", numeric.round_half_up(value, 2))
        .drop("product", "fee_bps")
    )


CONTEXT = ("user_id", "tier", "region", "age_band", "risk_profile")


def context_columns(products: Sequence[str]) -> list[str]:
    return [*CONTEXT, *(f"pre_{p}_interactions" for p in products), "trades_total", "active_days"]


def with_context(scores: DataFrame, features: DataFrame, products: Sequence[str]) -> DataFrame:
    """Scores plus the profile columns that outreach and reports need; unique keys on both sides."""
    return features.select(*context_columns(products)).join(scores, "user_id", "inner")


def recommendations(scored: DataFrame, catalog: DataFrame, settings: Settings) -> DataFrame:
    """The base table from scores with context: pick, value and targeting decile."""
    valued = expected_value(assemble(scored, settings.products), catalog, settings)
    return rank.quantile_cut(valued, "propensity_score", "user_id")


def eligible(long_scores: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Drop (user, product) rows that break the product's suitability rule.

    A rule is a SQL predicate on the row; products without a rule are open to everyone and an
    undecided (NULL) rule excludes. A map-side filter: no join, nothing to broadcast.
    """
    allowed = F.lit(True)
    for product, predicate in rules.items():
        allowed = F.when(F.col("product") == product,
                         F.coalesce(F.expr(predicate), F.lit(False))).otherwise(allowed)
    return long_scores.where(allowed)


def scorecard(df: DataFrame, weights: Mapping[str, float], intercept: float,
              name: str = "score") -> DataFrame:
    """Logistic score with fixed weights over numeric columns or SQL expressions."""
    total = F.lit(float(intercept))
    for expression, weight in weights.items():
        total = total + F.lit(float(weight)) * F.expr(expression)
    return df.withColumn(name, numeric.round_half_up(numeric.sigmoid(total), 6))
