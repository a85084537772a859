"""Masked dimension tables and an audit for personal data that slipped through."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlab.functions.masking import MASKS, RAW_PATTERNS, looks_raw


def secure_view(users: DataFrame, privileged: bool = False) -> DataFrame:
    """All users with masked personal columns; nothing else changes."""
    return users.withColumns({
        c: mask(F.col(c), privileged) for c, mask in MASKS.items() if c in users.columns
    })


def audit_table(df: DataFrame, table: str,
                patterns: Mapping[str, str] = RAW_PATTERNS) -> DataFrame:
    """Values per text column that look like unmasked personal data; one pass over the table.

    Every text column is checked against every pattern, so a renamed column is found too.
    """
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    checks = [(c, kind, p) for c in text for kind, p in patterns.items()]
    if not checks:
        return df.sparkSession.createDataFrame(
            [], "table_name string, column_name string, kind string, violations long")
    counts = df.agg(*[
        F.count_if(looks_raw(F.col(c), p)).alias(f"_v{i}") for i, (c, _, p) in enumerate(checks)])
    rows = F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                 F.lit(kind).alias("kind"), F.col(f"_v{i}").alias("violations"))
        for i, (c, kind, _) in enumerate(checks)])
    return counts.select(F.inline(rows))


def audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    reports = [audit_table(df, name) for name, df in tables.items()]
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result
