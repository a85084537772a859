"""Expectations on rows: drop, count or quarantine the rows that fail them.

A rule is a SQL predicate; a predicate that is NULL counts as failed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, str]


def _holds(predicate: str) -> Column:
    return F.coalesce(F.expr(predicate), F.lit(False))


def _all_hold(rules: Rules) -> Column:
    result = F.lit(True)
    for predicate in rules.values():
        result = result & _holds(predicate)
    return result


def expect_or_drop(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep the rows that satisfy every rule; works on batches and on streams."""
    return df.where(_all_hold(rules))


def split(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(good rows, failed rows with the names of the rules they broke)."""
    broken = F.array_compact(F.array(*[
        F.when(~_holds(predicate), F.lit(name)) for name, predicate in rules.items()
    ]))
    bad = df.where(~_all_hold(rules)).withColumn("failed_rules", F.array_join(broken, ","))
    return expect_or_drop(df, rules), bad


def expectation_report(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule with passed and failed counts; one pass, one partial aggregation."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(_holds(p)).alias(f"_ok_{i}") for i, p in enumerate(rules.values())],
    )
    rows = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"_ok_{i}").alias("passed"),
                 (F.col("_n") - F.col(f"_ok_{i}")).alias("failed"))
        for i, name in enumerate(rules)
    ])
    return counts.select(F.inline(rows))


def observe(df: DataFrame, name: str | Observation, rules: Rules) -> DataFrame:
    """Attach the same counters to a running query, batch or stream, without a second pass."""
    return df.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(~_holds(p)).alias(f"failed_{rule}") for rule, p in rules.items()],
    )
