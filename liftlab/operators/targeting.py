"""Top-k lists and cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlab.operators import rank


def top_users(recs: DataFrame, k: int, product: str | None = None,
              score: str = "propensity_score", key: str = "user_id") -> DataFrame:
    """The k users with the highest score, best first, of one recommended product if given.

    The list is k rows, which is also the most that a task keeps and sends; ``recs`` is read once.
    """
    chosen = recs if product is None else recs.where(F.col("recommended_product") == product)
    return chosen.orderBy(*rank.best_first(chosen, score, key)).limit(k)


def flag_top_k(df: DataFrame, k: int, score: str = "propensity_score", key: str = "user_id",
               name: str = "is_top_k") -> DataFrame:
    """Mark the k best rows and keep all others.

    Only the k-th (score, key) is looked up; rows are then compared with it, so wide rows are
    neither sorted nor joined.
    """
    return df.withColumn(name, rank.within_top(df, score, key, k))


def cohort(recs: DataFrame, max_decile: int) -> DataFrame:
    return recs.where(F.col("targeting_decile") <= max_decile)


def export_cohort(recs: DataFrame, max_decile: int, path: str) -> None:
    """Write the targeted users, one folder per recommended product."""
    (cohort(recs, max_decile).write.mode("overwrite")
     .partitionBy("recommended_product").parquet(path))
