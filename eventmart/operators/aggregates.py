"""Aggregation building blocks.

Two plan choices matter at scale.  Several ``count_distinct`` over *one* column under different
conditions are planned from a single pre-aggregation instead of one Expand branch each.  ``max`` of
a string forces a sort-based aggregate, so names are reduced to their few distinct values first and
then joined back on the grouping keys, which both sides are already partitioned by.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_event_types(columns: Mapping[str, str], event_type: str = "event_type") -> list[Column]:
    """One count per (alias, event type), to be used inside ``agg``."""
    return [F.count_if(F.col(event_type) == t).alias(alias) for alias, t in columns.items()]


def conditional_distinct(
    df: DataFrame, keys: Sequence[str], value: str, conditions: Mapping[str, Column | None]
) -> DataFrame:
    """Per group, distinct non-null ``value``s under each condition (None: no condition).

    First one row per (keys, value) with a flag per condition, which also spreads a hot group over
    its values; then plain counts.
    """
    flags = {
        alias: F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
        for alias, condition in conditions.items()
    }
    pairs = df.groupBy(*keys, value).agg(*[F.bool_or(flag).alias(alias) for alias, flag in flags.items()])
    present = F.col(value).isNotNull()
    return pairs.groupBy(*keys).agg(*[F.count_if(present & F.col(a)).alias(a) for a in conditions])


def with_names(
    aggregated: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    names: Sequence[str],
    policy: str = "max",
    ordered_by: str = "created_at",
) -> DataFrame:
    """Add one value of each name column per group of non-null ``keys``.

    ``policy="max"`` takes the alphabetically last value; ``"latest"`` the one on the newest row
    (ties: alphabetically last).
    """
    distinct = rows.groupBy(*keys, *names).agg(F.max(ordered_by).alias("__newest"))
    if policy == "max":
        # Not max(n): under a duplicate-insensitive aggregate Catalyst would drop the step above.
        picked = [F.max_by(n, n).alias(n) for n in names]
    elif policy == "latest":
        order = lambda n: F.when(F.col(n).isNotNull(), F.struct("__newest", n))
        picked = [F.max_by(n, order(n)).alias(n) for n in names]
    else:
        raise ValueError(f"unknown name policy {policy!r}")
    return aggregated.join(distinct.groupBy(*keys).agg(*picked), list(keys), "left")


def group_by_expression(
    df: DataFrame, label: Column, alias: str, measures: Sequence[Column], order: Column | None = None
) -> DataFrame:
    """Group by a computed label; ``order`` may sort by an aggregate that is not returned."""
    grouped = df.groupBy(label.alias(alias)).agg(
        *measures, *([] if order is None else [order.alias("__order")])
    )
    return grouped if order is None else grouped.orderBy(F.desc("__order"), alias).drop("__order")
