"""Staging models: cleaned events, and one row per actor, repository and organization.

Counts and timestamps are hash-aggregated over the events; names (``max`` of a string) come from a
separate narrow pass, see ``operators.aggregates.with_names``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_bot, repo_owner, repo_slug, time_parts
from ..operators.aggregates import with_names
from ..operators.filters import entity_not_null, exclude_event_types, quality_filter
from ..schemas import EXCLUDED_EVENT_TYPES

# The columns of staged events.
EVENT_COLUMNS = [
    "event_id",
    "event_date",
    "event_type",
    "created_at",
    "actor_id",
    "actor_login",
    "repo_id",
    "repo_name",
    "org_id",
    "org_login",
    "is_public",
    "payload",
    "source_file",
    "ingested_at",
    "updated_at",
]


def clean_projection(raw: DataFrame) -> DataFrame:
    return raw.select(*EVENT_COLUMNS)


def add_bot_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_bot", is_bot())


def add_time_dimensions(df: DataFrame) -> DataFrame:
    return df.withColumns(time_parts())


def staging_events(raw: DataFrame, excluded: Sequence[str] = EXCLUDED_EVENT_TYPES) -> DataFrame:
    """Raw -> 21 columns, one row per kept event.  Narrow: no shuffle."""
    return (
        raw.transform(clean_projection)
        .transform(quality_filter)
        .transform(exclude_event_types, excluded)
        .transform(add_bot_flag)
        .transform(add_time_dimensions)
    )


#: What the entity models tell apart within a day.
DAY_KEYS = ["event_date", "actor_id", "actor_login", "repo_id", "repo_name", "org_id", "org_login", "event_type"]


def activity_days(events: DataFrame) -> DataFrame:
    """State of the entity models: staged events of one day that are alike in DAY_KEYS as one row.

    The entity models of several days, or of all, come from their states as they come from the events: counts add up,
    first and last times merge, and sets of values are the values of the rows.  A state depends on the events of its
    date alone, and no row grows with the size of an entity.
    """
    return events.groupBy(*DAY_KEYS).agg(
        F.count("*").alias("n_events"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
        F.bool_or("is_bot").alias("is_bot"),
        F.bool_or("is_public").alias("is_public"),
    )


def _stored(rows: DataFrame) -> bool:
    """Whether ``rows`` are activity days, not events."""
    return "n_events" in rows.columns


def _activity(rows: DataFrame, *extra):
    """Measures every entity shares, with the entity's own in the middle."""
    first, last = ("first_at", "last_at") if _stored(rows) else ("created_at", "created_at")
    return [
        F.min(first).alias("first_seen_at"),
        F.max(last).alias("last_seen_at"),
        (F.sum("n_events") if _stored(rows) else F.count("*")).alias("total_events"),
        *extra,
        F.count_distinct("event_date").alias("active_days"),
    ]


def _named(counted: DataFrame, rows: DataFrame, key: str, name: str, policy: str) -> DataFrame:
    return with_names(counted, rows, [key], [name], policy, "last_at" if _stored(rows) else "created_at")


def stg_actors(events: DataFrame, name_policy: str = "max") -> DataFrame:
    """From staged events or their activity days."""
    counted = events.groupBy("actor_id").agg(
        F.bool_or("is_bot").alias("is_bot"),
        *_activity(
            events,
            F.count_distinct("event_type").alias("unique_event_types"),
            F.count_distinct("repo_id").alias("unique_repositories"),
        ),
    )
    return _named(counted, events, "actor_id", "actor_login", name_policy).select(
        "actor_id", "actor_login", *counted.columns[1:]
    )


def stg_repositories(events: DataFrame, name_policy: str = "max") -> DataFrame:
    """From staged events or their activity days."""
    named = entity_not_null(events, "repo_id", "repo_name")
    counted = named.groupBy("repo_id").agg(
        F.bool_or("is_public").alias("is_public"),
        F.bool_or(F.col("org_id").isNotNull()).alias("is_org_owned"),
        *_activity(
            named,
            F.count_distinct("actor_id").alias("unique_contributors"),
            F.count_distinct("event_type").alias("unique_event_types"),
        ),
    )
    return _named(counted, named, "repo_id", "repo_name", name_policy).select(
        "repo_id",
        "repo_name",
        repo_owner("repo_name").alias("repo_owner"),
        repo_slug("repo_name").alias("repo_slug"),
        *counted.columns[1:],
    )


def stg_organizations(events: DataFrame, name_policy: str = "max") -> DataFrame:
    """From staged events or their activity days."""
    named = entity_not_null(events, "org_id", "org_login")
    counted = named.groupBy("org_id").agg(
        *_activity(
            named,
            F.count_distinct("repo_id").alias("total_repositories"),
            F.count_distinct("actor_id").alias("unique_contributors"),
            F.count_distinct("event_type").alias("unique_event_types"),
        )
    )
    return _named(counted, named, "org_id", "org_login", name_policy).select(
        "org_id", "org_login", *counted.columns[1:]
    )
