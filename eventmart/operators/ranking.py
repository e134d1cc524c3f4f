"""Shares of total, de-duplication by rank, and top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import percent
from ..sources.event_files import parse_lines


def pct_of_total(grouped: DataFrame, measure: str, alias: str = "percentage") -> DataFrame:
    """Add each row's share of the grand total of ``measure``.

    For results grouped by a category (event type, tier, level): the empty window puts its input in
    one task, and that input has one row per category.
    """
    total = F.sum(measure).over(Window.partitionBy())
    return grouped.withColumn(alias, percent(F.col(measure), total))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep row 1 per key in the given order.

    Catalyst also limits each map task to its own best row per key before the shuffle, so a key with
    very many copies does not travel.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def top_k(df: DataFrame, measure: str, k: int, *tie_break: str) -> DataFrame:
    """The k largest by ``measure``; ties go by ``tie_break``.  Each task keeps k rows."""
    return df.orderBy(F.desc(measure), *tie_break).limit(k)


def order_by_case(df: DataFrame, column: str, ranks: Mapping[str, int] | Sequence[str]) -> DataFrame:
    """Sort by a custom rank of the column's values; values without a rank come last."""
    if not isinstance(ranks, Mapping):
        ranks = {value: position for position, value in enumerate(ranks)}
    rank = F.lit(None).cast("int")
    for value, position in ranks.items():
        rank = F.when(F.col(column) == value, position).otherwise(rank)
    return df.orderBy(rank.asc_nulls_last(), column)


def latest_row(df: DataFrame, value: str = "source_file", order: str = "created_at") -> DataFrame:
    """One row: ``value`` on the newest row (ties: alphabetically last)."""
    return df.agg(F.max_by(value, F.struct(order, value)).alias(value))


def head_sample_profile(lines: DataFrame, limit: int = 10, order: Sequence[str] = ()) -> DataFrame:
    """Event-type counts over the first ``limit`` lines; a line without a type counts as "Unknown".

    Lines that are not JSON count towards the limit but not towards the profile.
    """
    head = (lines.orderBy(*order) if order else lines).limit(limit)
    readable = F.coalesce(F.col("reject_reason"), F.lit("")) != "malformed"
    return (
        parse_lines(head)
        .filter(readable)
        .groupBy(F.coalesce(F.col("event.type"), F.lit("Unknown")).alias("event_type"))
        .agg(F.count("*").alias("events"))
    )
