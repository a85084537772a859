"""Numeric column helpers with the same result on every engine and every partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# From here on a double has no fraction, and floor(), which gives a long, could saturate.
_WHOLE = float(1 << 52)


def round_half_up(col: Column, digits: int = 0) -> Column:
    """Half-up rounding by plain arithmetic, so that ties do not depend on the engine.

    A number too large to have such digits stays as it is, and so do NaN and the infinities.
    """
    unit = float(10 ** digits)
    value = col.cast("double")
    scaled = value * F.lit(unit)
    return F.when(F.abs(scaled) < F.lit(_WHOLE), F.floor(scaled + F.lit(0.5)) / F.lit(unit)).otherwise(value)


def finite(col: Column) -> Column:
    """NaN and the infinities as NULL, for amounts that were read from text."""
    return F.when(~F.isnan(col) & (F.abs(col) < F.lit(float("inf"))), col)


def whole_steps(col: Column, steps: float) -> Column:
    """The number of steps in ``col``, rounded half up; a value that is not finite ends the query."""
    scaled = col * F.lit(steps)
    checked = F.when(scaled.isNotNull() & finite(scaled).isNull(),
                     F.raise_error(F.lit("a sum met a number that is not finite")).cast("double")).otherwise(scaled)
    return F.when(F.abs(scaled) < F.lit(_WHOLE), F.floor(scaled + F.lit(0.5)).cast("decimal(38,0)")) \
        .otherwise(checked.cast("decimal(38,0)"))


def money_sum(col: Column) -> Column:
    """Exact, order-independent sum of amounts in cents (a decimal sum, not a double sum)."""
    return exact_sum(col, 100.0)


def exact_sum(col: Column, steps: float = 1e9) -> Column:
    """Sum of doubles in fixed steps: the same on every partitioning, unlike a double sum."""
    return F.sum(whole_steps(col, steps)).cast("double") / F.lit(steps)


def mean(col: Column, digits: int) -> Column:
    """Rounded average of an order-independent sum; a tie cannot tip with the row order."""
    return round_half_up(exact_sum(col) / F.count(col), digits)


def no_nan(col: Column) -> Column:
    """NaN as NULL: comparisons and exports must not see NaN as the largest number."""
    return F.when(~F.isnan(col), col)


def to_number(name: str) -> Column:
    """Text to double; anything unreadable, NULL or NaN becomes 0."""
    return F.coalesce(no_nan(F.col(name).try_cast("double")), F.lit(0.0))


def sigmoid(col: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col))


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """part / whole in percent, rounded half up; NULL for an empty whole."""
    return round_half_up(part * F.lit(100.0) / F.when(whole != 0, whole), digits)
