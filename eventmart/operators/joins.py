"""Joins that hold when one key owns a large share of the rows.

Adaptive skew handling only rewrites a join whose two inputs are plain shuffles; it leaves alone a
join against a freshly aggregated side.  The lookups here are aggregates that already carry a row
count per key, so the hot keys are known and are joined by broadcast instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A key with at least this many rows counts as hot.  R rows hold at most R / HOT_ROWS hot keys, so
#: the broadcast side is bounded: 100 TB of 1 KB events give at most 100,000 of them.
HOT_ROWS = 1_000_000


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    columns: Sequence[str],
    weight: str,
    spread_by: str,
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``columns`` of a unique-keyed ``lookup`` to ``rows``; ``how`` is left or inner.

    ``weight`` is the lookup's count of rows per key and ``spread_by`` a high-cardinality column of
    ``rows``.  Hot keys match by broadcast.  Rows already matched, and rows with a NULL key, go to the
    second join under a made-up key that spreads them over all tasks and matches nothing.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    side = lambda name: [F.col(c).alias(f"__{name}_{c}") for c in (key, *columns)]
    hot = lookup.filter(F.col(weight) >= hot_rows).select(*side("hot"))
    cold = lookup.filter(F.col(weight) < hot_rows).select(*side("cold"))
    hot_key, cold_key = F.col(f"__hot_{key}"), F.col(f"__cold_{key}")
    spread = F.concat(F.lit("\0"), F.xxhash64(spread_by).cast("string"))
    joined = (
        rows.join(F.broadcast(hot), F.col(key) == hot_key, "left")
        .withColumn("__key", F.when(hot_key.isNotNull() | F.col(key).isNull(), spread).otherwise(F.col(key)))
        .join(cold, F.col("__key") == cold_key, "left")
    )
    if how == "inner":
        joined = joined.filter(hot_key.isNotNull() | cold_key.isNotNull())
    found = {c: F.coalesce(f"__hot_{c}", f"__cold_{c}") for c in columns}
    helpers = [f"__{name}_{c}" for name in ("hot", "cold") for c in (key, *columns)]
    return joined.withColumns(found).drop("__key", *helpers)


def join_first_seen(df: DataFrame, key: str, date: str = "event_date") -> DataFrame:
    """One row per (key, date) of ``df`` with the key's first date; other columns must be gone.

    The window runs over distinct (key, date) pairs, so a group is at most one row per calendar day.
    """
    return df.withColumn("first_seen", F.min(date).over(Window.partitionBy(key)))


def compare_periods(
    df: DataFrame, key: str, measure: str, current: Column, previous: Column
) -> DataFrame:
    """Per key, the measure summed over two periods: (key, current_events, previous_events).

    Same rows as left-joining the previous period's totals to the current period's, in one scan and
    one shuffle.  Keys without a row in the current period are dropped; ``previous_events`` is NULL
    for keys without a row in the previous one.
    """
    return (
        df.filter(current | previous)
        .groupBy(key)
        .agg(
            F.sum(F.when(current, F.col(measure))).alias("current_events"),
            F.sum(F.when(previous, F.col(measure))).alias("previous_events"),
        )
        .filter(F.col("current_events").isNotNull())
    )


def join_dimension(df: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Inner equi-join of one-row-per-key results to a dimension; neither side has hot keys."""
    return df.join(dimension.select(key, *columns), key, "inner")


def event_category_lookup(df: DataFrame, categories: DataFrame) -> DataFrame:
    """Left-join the category lookup; unknown types get NULLs.

    Fifteen rows are broadcast by their known size; a lookup from a larger file is broadcast only if that file is
    below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    return df.join(categories, "event_type", "left")


def orphan_values(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """(column, orphan_rows): non-null child values missing from the parent, SQL ``NOT IN`` rules.

    A single NULL in the parent column leaves no orphan at all.  Child rows are counted per value
    before the join, so a hot value is one row by then.  ``NOT IN`` itself would broadcast the parent.
    """
    counted = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("orphan_rows"))
    keys = parent.select(F.col(parent_column).alias("__parent"))
    missing = counted.join(keys, F.col(column) == F.col("__parent"), "left_anti")
    return missing.filter(~keys.filter(F.col("__parent").isNull()).exists())


def anti_join_orphans(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    spread_by: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The child rows behind ``orphan_values``, with all their columns."""
    orphans = orphan_values(child, column, parent, parent_column)
    return lookup_join(
        child, orphans, column, ["orphan_rows"], "orphan_rows", spread_by, "inner", hot_rows
    ).drop("orphan_rows")
