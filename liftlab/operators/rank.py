"""Global ranks, running sums and quantile cuts without a one-task window.

``row_number() OVER (ORDER BY score)`` sends every row to one task. Here the rows are range
partitioned by the full order, which always ends in a unique key: equal scores, however many,
are spread over partitions by that key. Each task sorts its range and numbers its rows; the
result is written once to the shared scratch folder, so the second pass (one count per range,
added up and broadcast) sees the very same ranges even after executors were lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftlab import session
from liftlab.functions import numeric

_PART = "_range"
_POS = "_position"
_BEFORE = "_before"
# monotonically_increasing_id() keeps the row number inside a partition in its low 33 bits.
_POSITION_BITS = (1 << 33) - 1


def _score(df: DataFrame, score: str) -> Column:
    kind = dict(df.dtypes)[score]
    return numeric.no_nan(F.col(score)) if kind in ("double", "float") else F.col(score)


def _order(df: DataFrame, score: str, key: str, ascending: bool) -> list[Column]:
    value = _score(df, score)
    first = value.asc_nulls_last() if ascending else value.desc_nulls_last()
    return [first, F.col(key).asc()]


def best_first(df: DataFrame, score: str, key: str) -> list[Column]:
    """The order of ``global_rank``: highest score first, ties by key, missing scores last."""
    return _order(df, score, key, ascending=False)


def ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` with its range number and position, written once in that order.

    The number of ranges is left to Spark: AQE joins neighbouring small ones, which keeps the
    order of the ranges.
    """
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)))
    )
    return session.written(placed, "ranges")


def _offsets(per_range: DataFrame, sums: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Totals of all earlier ranges; the input has one row per range (and group)."""
    earlier = (Window.partitionBy(*within).orderBy(_PART)
               .rowsBetween(Window.unboundedPreceding, -1))
    return per_range.select(*within, _PART, *[
        F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{_BEFORE}_{c}") for c in sums])


def _narrow(df: DataFrame, score: str, key: str) -> DataFrame:
    return df.select(_score(df, score).alias("_v"), F.col(key).alias("_k"))


def _ranked(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Adds the 1-based rank and the number of rows, ``_n``."""
    table = ranges(df, order)
    per_range = table.groupBy(_PART).agg(F.count(F.lit(1)).alias("rows"))
    everything = Window.partitionBy(F.lit(0))
    # One row per range, so at most one per shuffle partition.
    offsets = (_offsets(per_range, ["rows"]).join(per_range, _PART)
               .withColumn("_n", F.sum("rows").over(everything)).drop("rows"))
    return (
        table.join(F.broadcast(offsets), _PART)
        .withColumn(name, F.col(f"{_BEFORE}_rows") + F.col(_POS) + F.lit(1))
        .drop(_PART, _POS, f"{_BEFORE}_rows")
    )


def global_rank(df: DataFrame, score: str, key: str, ascending: bool = False,
                name: str = "overall_rank") -> DataFrame:
    """1..n by score, ties by the unique key; NULL and NaN scores come last."""
    return _ranked(df, _order(df, score, key, ascending), name).drop("_n")


def quantile_cut(df: DataFrame, score: str, key: str, groups: int = 10,
                 name: str = "targeting_decile") -> DataFrame:
    """Quantile group of the ascending first-come rank, 1 = highest scores.

    The cut points are the linear quantiles of the ranks 1..n, group borders belong to the
    lower group. This differs from ntile() unless the groups come out equal. Rows without a
    score rank below all others. Only (score, key) is shuffled and written, to find the last pair
    of each group; ``df`` itself is compared with these borders where it is. It is therefore read
    twice: pass a written table if it is costly.
    """
    ranked = _ranked(_narrow(df, score, key), [F.col("_v").asc_nulls_first(), F.col("_k").asc()], "_rank")
    span = "greatest(_n - 1, 1)"
    upper = F.expr(f"({groups} * (_rank - 1) + {span} - 1) DIV {span}")
    cut = F.when(F.col("_n") == 1, F.lit(1)).otherwise(F.lit(groups) - F.greatest(upper - 1, F.lit(0)))
    place = F.struct(F.col("_v"), F.col("_k"))
    borders = ranked.groupBy(cut.cast("int").alias("cut")).agg(F.max(place).alias("upto"))
    # one border per group; structs sort with NULL first, as the ranks do
    table = borders.agg(F.array_sort(F.collect_list(F.struct("upto", "cut")))).scalar()
    own = F.struct(_score(df, score).alias("_v"), F.col(key).alias("_k"))
    found = F.filter(F.col("_borders"), lambda b: b["upto"] >= own)
    return df.withColumn("_borders", table).withColumn(name, F.get(found, F.lit(0))["cut"]).drop("_borders")


def within_top(df: DataFrame, score: str, key: str, k: int) -> Column:
    """True for the k first rows by (score desc, key); NULL and NaN scores come last.

    The k-th (score, key) is read off the distributed rank of these two columns alone, whatever k
    is, and comes back as a scalar subquery; the rows of ``df`` are then compared with it in place.
    """
    if k <= 0:
        return F.lit(False)
    ranked = _ranked(_narrow(df, score, key), [F.col("_v").desc_nulls_last(), F.col("_k").asc()], "_rank")
    kth = ranked.where(F.col("_rank") == k).select(F.struct("_v", "_k")).scalar()
    value, own, least, last = _score(df, score), F.col(key), kth["_v"], kth["_k"]
    tie = own.isNull() | F.coalesce(own <= last, F.lit(False))
    inside = F.when(value.isNull(), least.isNull() & tie) \
        .otherwise(least.isNull() | (value > least) | ((value == least) & tie))
    return F.when(kth.isNull(), F.lit(True)).otherwise(inside)  # fewer than k rows


def running_sums(df: DataFrame, order: Sequence[Column], sums: Sequence[str],
                 within: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums ``cum_{c}`` along a unique order, per group of ``within``.

    ``order`` has to start with the ``within`` columns. A group may be larger than a task: it
    is spread over ranges, and only the totals per range are added up across them.
    """
    table = ranges(df, order)
    totals = table.groupBy(*within, _PART).agg(*[F.sum(c).alias(c) for c in sums])
    so_far = (Window.partitionBy(*within, _PART).orderBy(_POS)
              .rowsBetween(Window.unboundedPreceding, 0))
    running = table.select("*", *[F.sum(c).over(so_far).alias(f"cum_{c}") for c in sums])
    # null-safe: a NULL group is a group
    names = {c: f"_of_{c}" for c in [*within, _PART]}
    offsets = _offsets(totals, sums, within).withColumnsRenamed(names)
    joined = running.join(offsets, [F.col(c).eqNullSafe(F.col(of)) for c, of in names.items()]) \
        .drop(*names.values())
    return joined.withColumns({
        f"cum_{c}": F.col(f"cum_{c}") + F.col(f"{_BEFORE}_{c}") for c in sums
    }).drop(_PART, _POS, *[f"{_BEFORE}_{c}" for c in sums])
