"""Row filters.  Date bounds are literals, so they prune date folders and reach the parquet scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_of_date
from ..functions.calendar import AsOf
from ..schemas import EXCLUDED_EVENT_TYPES, QUALITY_COLUMNS


def quality_filter(df: DataFrame, columns: Sequence[str] = QUALITY_COLUMNS) -> DataFrame:
    """Keep rows whose identifying columns are all present."""
    return entity_not_null(df, *columns)


def exclude_event_types(df: DataFrame, excluded: Sequence[str] = EXCLUDED_EVENT_TYPES) -> DataFrame:
    return df.filter(~F.col("event_type").isin(*excluded)) if excluded else df


def entity_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows with all columns present; plain IS NOT NULL tests, which the parquet scan takes."""
    return df.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in columns))


def trailing_days(df: DataFrame, days: int, as_of: AsOf = None, date: str = "event_date") -> DataFrame:
    """Dates from ``as_of - days`` on, both ends included: N days keep N + 1 dates."""
    return df.filter(F.col(date) >= F.date_sub(as_of_date(as_of), days))


def between_days(
    df: DataFrame, from_days: int, to_days: int, as_of: AsOf = None, date: str = "event_date"
) -> DataFrame:
    """Dates in [as_of - from_days, as_of - to_days)."""
    today = as_of_date(as_of)
    return df.filter(
        (F.col(date) >= F.date_sub(today, from_days)) & (F.col(date) < F.date_sub(today, to_days))
    )


def event_type_in(df: DataFrame, types: Sequence[str]) -> DataFrame:
    return df.filter(F.col("event_type").isin(*types))


def exclude_bots(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_bot"))


def dashboard_filters(
    df: DataFrame,
    date_from: AsOf = None,
    date_to: AsOf = None,
    event_types: Sequence[str] | None = None,
    bots: str = "all",
    repo_name: str | None = None,
) -> DataFrame:
    """The dashboard's parameter panel; an unset parameter adds no filter.

    ``bots``: ``all``, ``only`` or ``none``.
    """
    if bots not in ("all", "only", "none"):
        raise ValueError(f"unknown bots option {bots!r}")
    if date_from is not None:
        df = df.filter(F.col("event_date") >= as_of_date(date_from))
    if date_to is not None:
        df = df.filter(F.col("event_date") <= as_of_date(date_to))
    if event_types:
        df = event_type_in(df, event_types)
    if bots != "all":
        df = df.filter(F.col("is_bot") == (bots == "only"))
    if repo_name is not None:
        df = df.filter(F.col("repo_name") == repo_name)
    return df
