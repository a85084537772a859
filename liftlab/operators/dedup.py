"""Latest-wins and first-wins de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RN = "_dedup_rn"


def latest(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """The newest row per key.

    Remaining columns break ties, so rows that still tie are equal and any of them will do.
    Catalyst puts a partial group limit before the shuffle: a key that was delivered a
    billion times leaves each map task as one row.
    """
    ties = [f.name for f in df.schema.fields if f.name not in keys and f.name not in newest_first
            and "map<" not in f.dataType.simpleString()]  # maps have no order
    order = [F.col(c).desc_nulls_last() for c in [*newest_first, *ties]]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(window)).where(F.col(_RN) == 1).drop(_RN)


def stream_first(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """The first row per key of a stream; state lives as long as the watermark delay.

    A stream cannot take back a row it has emitted, so it keeps the first delivery; the batch
    form above, which keeps the latest, stays the truth for silver tables.
    """
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
