"""Numeric expressions. Money stays decimal from the scan to the marts."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(12,2)"
LINE_TOTAL = "decimal(18,2)"


def is_negative(number: Column) -> Column:
    """True below zero, false otherwise; a missing number is not negative."""
    return F.coalesce(number < 0, F.lit(False))


def floored_at_zero(number: Column, dtype: T.DataType) -> Column:
    return F.when(number < 0, F.lit(0).cast(dtype)).otherwise(number)


def outside(number: Column, low, high) -> Column:
    return (number < low) | (number > high)


def clipped(number: Column, low, high, dtype: T.DataType) -> Column:
    """Clip to ``[low, high]``; NULL stays NULL (``greatest``/``least`` would skip it)."""
    return (
        F.when(number < low, F.lit(low).cast(dtype))
        .when(number > high, F.lit(high).cast(dtype))
        .otherwise(number)
    )


def safe_int(value: Column, dtype: T.DataType) -> Column:
    """Whole part as int; NULL for text that is no number and for overflow."""
    if isinstance(dtype, T.IntegerType):
        return value
    if isinstance(dtype, T.StringType):  # a direct cast would refuse a fraction
        value = value.try_cast("double")
    return value.try_cast("int")


def band(number: Column, uppers: Sequence[tuple[object, str, bool]], top: str,
         missing: str = "UNKNOWN") -> Column:
    """Label of the first interval holding ``number``.

    ``uppers`` lists ``(bound, label, inclusive)`` in ascending order; numbers past
    the last bound get ``top`` and NULL gets ``missing``.
    """
    label = F.when(number.isNull(), F.lit(missing))
    for bound, name, inclusive in uppers:
        label = label.when((number <= bound) if inclusive else (number < bound), F.lit(name))
    return label.otherwise(F.lit(top))


def differs(left: Column, right: Column, tolerance: Decimal) -> Column:
    return F.abs(left - right) > F.lit(tolerance)


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; 0.0 when there is no positive whole."""
    share = part.cast("double") / whole.cast("double") * F.lit(100.0)
    return F.when(whole > 0, share).otherwise(F.lit(0.0))


def mean(number: Column) -> Column:
    """Average as exact sum over count, so decimals lose nothing before the division."""
    return F.sum(number).cast("double") / F.count(number)
