"""Exact ranking metrics for binary labels, optionally per group.

Rows are reduced to one row per distinct score first (partial aggregation), which removes ties
and hot scores; the rest is a distributed running sum. Rows without a score or a label, and NaN
scores, are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftlab.functions import numeric
from liftlab.operators import rank


def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    value = numeric.no_nan(F.col(score).cast("double"))
    return (
        df.select(*by, value.alias("score"), F.col(label).cast("int").alias("label"))
        .where("score IS NOT NULL AND label IS NOT NULL")
        .groupBy(*by, "score")
        .agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg"))
    )


def _from_best(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    order = [*[F.col(c).asc() for c in by], F.col("score").desc()]
    return rank.running_sums(counts, order, ["pos", "neg"], by)


def ranking_metrics(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """roc_auc and avg_precision per group; NULL where only one class occurs.

    AUC counts, for every positive, the negatives below it and half of those beside it.
    Average precision is the step sum over distinct scores, not a trapezoid.
    """
    steps = _from_best(score_counts(df, score, label, by), by)
    pos, cum_pos, cum_neg = (F.col(c).cast("double") for c in ("pos", "cum_pos", "cum_neg"))
    twice = F.expr("CAST(pos AS DECIMAL(19,0)) * (2 * CAST(cum_neg AS DECIMAL(17,0)) - neg)")
    sums = steps.groupBy(*by).agg(
        F.sum("pos").alias("_p"), F.sum("neg").alias("_q"),
        # negatives ranked above this score (two halves) or beside it (one half), as an exact sum
        F.sum(twice.cast("decimal(38,0)")).alias("_halves_above"),
        numeric.exact_sum(pos * (cum_pos / (cum_pos + cum_neg))).alias("_precision"),
    )
    both = (F.col("_p") > 0) & (F.col("_q") > 0)
    pairs = F.col("_p").cast("double") * F.col("_q").cast("double")
    above = F.col("_halves_above").cast("double") / F.lit(2.0)
    return sums.select(
        *by,
        numeric.round_half_up(F.when(both, (pairs - above) / pairs), 6).alias("roc_auc"),
        numeric.round_half_up(F.when(both, F.col("_precision") / F.col("_p")), 6).alias("avg_precision"),
    )


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, score, label, by).select(*by, "roc_auc")


def avg_precision(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, score, label, by).select(*by, "avg_precision")


def accuracy(df: DataFrame, score: str, label: str, threshold: float = 0.5,
             by: Sequence[str] = ()) -> DataFrame:
    scored = df.where(numeric.no_nan(F.col(score)).isNotNull() & F.col(label).isNotNull())
    hit = (F.col(score) >= F.lit(threshold)) == (F.col(label).cast("int") == 1)
    return scored.groupBy(*by).agg(
        numeric.round_half_up(F.count_if(hit) / F.count(F.lit(1)), 6).alias("accuracy"))


def base_rate(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        numeric.round_half_up(F.count_if(F.col(label) == 1) / F.count(F.col(label)), 6).alias("base_rate"))


def cumulative_gains(recs: DataFrame, adopted: str = "adopted") -> DataFrame:
    """Value and adopters captured by decile 1..k; the window sees one row per decile."""
    per_decile = recs.groupBy("targeting_decile").agg(
        F.count(F.lit(1)).alias("users"),
        numeric.money_sum(F.col("expected_annual_value_usd")).alias("value_usd"),
        F.sum(adopted).alias("adopters"))
    upto = Window.orderBy("targeting_decile").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(F.lit(0))
    return per_decile.select(
        "targeting_decile", "users", "value_usd", "adopters",
        numeric.share_pct(F.round(F.sum("value_usd").over(upto), 2), F.round(F.sum("value_usd").over(whole), 2))
        .alias("cum_value_pct"),
        numeric.share_pct(F.sum("adopters").over(upto), F.sum("adopters").over(whole))
        .alias("cum_adopters_pct"))


# ---------------------------------------------------------------- uplift
_ARMS = ["n_t", "y_t", "n_c", "y_c"]


def _arm_counts(df: DataFrame, score: str, variant: str, label: str, by: Sequence[str]) -> DataFrame:
    """Users and adopters of treatment and control per distinct score; rows of no arm are left out."""
    treated, control = F.col("arm") == "treatment", F.col("arm") == "control"
    bought = F.col("label") == 1
    return (
        df.select(*by, numeric.no_nan(F.col(score).cast("double")).alias("score"), F.col(variant).alias("arm"),
                  F.col(label).cast("int").alias("label"))
        .where("score IS NOT NULL AND label IS NOT NULL AND arm IN ('treatment', 'control')")
        .groupBy(*by, "score")
        .agg(F.count_if(treated).alias("n_t"), F.count_if(treated & bought).alias("y_t"),
             F.count_if(control).alias("n_c"), F.count_if(control & bought).alias("y_c")))


def _targeted(df: DataFrame, score: str, variant: str, label: str, by: Sequence[str]) -> DataFrame:
    """Running counts per arm from the best score on, one row per distinct score, with the group's size ``_n``."""
    counts = _arm_counts(df, score, variant, label, by)
    order = [*[F.col(c).asc() for c in by], F.col("score").desc()]
    running = rank.running_sums(counts, order, _ARMS, by)
    sizes = counts.groupBy(*[F.col(c).alias(f"_of_{c}") for c in by]).agg(F.sum(F.col("n_t") + F.col("n_c")).alias("_n"))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
    joined = running.join(sizes, same) if by else running.join(F.broadcast(sizes))  # one row
    return joined.drop(*[f"_of_{c}" for c in by])


def _gained(y_t: Column, n_t: Column, y_c: Column, n_c: Column) -> Column:
    """Adopters of the treatment above those that as many users of the control have; 0 without users in an arm."""
    y_t, n_t, y_c, n_c = (c.cast("double") for c in (y_t, n_t, y_c, n_c))
    return F.when((n_t > 0) & (n_c > 0), y_t - y_c * n_t / n_c).otherwise(F.lit(0.0))


def uplift_curve(df: DataFrame, score: str, variant: str, label: str, by: Sequence[str] = (), groups: int = 10,
                 value_usd: float = 1.0, cost_usd: float = 1.0) -> DataFrame:
    """What targeting the best 1..``groups`` parts by score would have gained over the control, per group of ``by``.

    A part ends at the first score with which at least its share of the users is reached, so equal scores stay together.
    uplift_pp: adoption rate of the treated less that of the control among the users targeted. incremental: the Qini
    curve, adopters above what the control predicts for as many users. roi_pct: their value less the cost of contacting the
    treated, in percent of that cost. Rates are NULL as long as one arm has no user. One row per distinct score is
    ranked, in ranges over all tasks; equal scores are added up before.
    """
    steps = _targeted(df, score, variant, label, by)
    upto = F.col("cum_n_t") + F.col("cum_n_c")
    before = upto - F.col("n_t") - F.col("n_c")
    first, last = (F.floor(groups * c / F.col("_n")).cast("int") for c in (before, upto))
    ends = steps.where(first < last).withColumn("part", F.explode(F.sequence(first + 1, last)))
    n_t, y_t, n_c, y_c = (F.col(f"cum_{c}") for c in _ARMS)
    gained = _gained(y_t, n_t, y_c, n_c)
    both = (n_t > 0) & (n_c > 0)
    rate = y_t.cast("double") / n_t - y_c.cast("double") / n_c
    return ends.select(
        *by, "part", n_t.alias("treated"), n_c.alias("control"), y_t.alias("adopters_treated"), y_c.alias("adopters_control"),
        numeric.round_half_up(F.when(both, rate * 100.0), 4).alias("uplift_pp"),
        numeric.round_half_up(gained, 4).alias("incremental"),
        numeric.round_half_up(F.when(both, (gained * value_usd - n_t * cost_usd) * 100.0 / (n_t * cost_usd)), 2).alias("roi_pct"))


def qini(df: DataFrame, score: str, variant: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Area between the Qini curve over all distinct scores and the line of random targeting, per user; 0 is no better."""
    steps = _targeted(df, score, variant, label, by)
    here = _gained(*[F.col(f"cum_{c}") for c in ("y_t", "n_t", "y_c", "n_c")])
    earlier = _gained(*[F.col(f"cum_{c}") - F.col(c) for c in ("y_t", "n_t", "y_c", "n_c")])
    size, width = F.col("_n").cast("double"), (F.col("n_t") + F.col("n_c")).cast("double")
    area = numeric.exact_sum((here + earlier) * width / (size * size * 2.0))
    last = F.max(F.when(F.col("cum_n_t") + F.col("cum_n_c") == F.col("_n"), here / (size * 2.0)))
    return steps.groupBy(*by).agg(numeric.round_half_up(area - last, 6).alias("qini"))
