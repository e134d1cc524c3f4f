"""Ratios, tiers and small-domain distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(numerator: str | Column, denominator: str | Column, factor: int = 1, scale: int = 2) -> Column:
    """``factor * numerator / denominator`` rounded half-up in exact decimals; NULL on a zero divisor.

    The division keeps 16 fractional digits for integer inputs up to 10^20, so the single visible
    rounding step is exact; a double division would miss ties such as 201/200.
    """
    top = (_column(numerator).cast("decimal(20,0)") * F.lit(factor)).cast("decimal(22,0)")
    bottom = F.nullif(_column(denominator).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(top / bottom, scale).cast("double")


def percent(part: str | Column, whole: str | Column) -> Column:
    return ratio(part, whole, factor=100)


def bucket(value: str | Column, lower_bounds: Sequence[tuple[int, str]], otherwise: str) -> Column:
    """Label by the first lower bound reached; bounds are given from high to low."""
    label = F.lit(otherwise)
    for bound, name in reversed(lower_bounds):
        label = F.when(_column(value) >= bound, name).otherwise(label)
    return label


def distinct_hours(hour: str = "event_hour") -> Column:
    """Exact count of distinct hours: a 24-bit mask OR-ed per group.

    A mask is one mergeable long, so unlike ``count_distinct`` it adds no Expand branch.
    """
    mask = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col(hour)))
    return F.coalesce(F.bit_count(mask), F.lit(0)).cast("long")
