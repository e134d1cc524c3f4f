"""Star schema (one fact, three dimensions) and the three daily aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    as_of_timestamp,
    bucket,
    distinct_hours,
    percent,
    ratio,
    repo_owner,
    repo_slug,
)
from ..functions.calendar import AsOf
from ..operators.aggregates import pivot_event_types, with_names
from ..operators.filters import entity_not_null
from ..operators.joins import HOT_ROWS, lookup_join
from ..schemas import (
    ACTIVITY_LEVELS,
    ACTOR_TYPE_COLUMNS,
    POPULARITY_TIERS,
    REPOSITORY_TYPE_COLUMNS,
)
from . import staging

BUILD_STAMP = "dbt_updated_at"


def stamp_build(df: DataFrame, run_at: AsOf = None) -> DataFrame:
    """Add the build timestamp every mart carries."""
    return df.withColumn(BUILD_STAMP, as_of_timestamp(run_at))


# --- derived dimension columns ------------------------------------------------------------------


def with_activity_level(df: DataFrame, levels: Sequence[tuple[int, str]] = ACTIVITY_LEVELS) -> DataFrame:
    return df.withColumn("activity_level", bucket("total_events", levels, "low"))


def with_popularity_tier(df: DataFrame, tiers: Sequence[tuple[int, str]] = POPULARITY_TIERS) -> DataFrame:
    return df.withColumn("popularity_tier", bucket("total_events", tiers, "low"))


def with_avg_events_per_day(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_events_per_day", ratio("total_events", "active_days"))


def with_contributor_diversity(df: DataFrame) -> DataFrame:
    return df.withColumn("contributor_diversity_pct", percent("unique_contributors", "total_events"))


def with_avg_events_per_repo(df: DataFrame, repositories: str = "total_repositories") -> DataFrame:
    return df.withColumn("avg_events_per_repo", ratio("total_events", repositories))


# --- dimensions -----------------------------------------------------------------------------------


def dim_actors(actors: DataFrame, run_at: AsOf = None) -> DataFrame:
    return (
        actors.transform(with_activity_level)
        .transform(with_avg_events_per_day)
        .transform(stamp_build, run_at)
    )


def dim_repositories(repositories: DataFrame, run_at: AsOf = None) -> DataFrame:
    return (
        repositories.transform(with_popularity_tier)
        .transform(with_avg_events_per_day)
        .transform(with_contributor_diversity)
        .transform(stamp_build, run_at)
    )


def dim_organizations(organizations: DataFrame, run_at: AsOf = None) -> DataFrame:
    return (
        organizations.transform(with_avg_events_per_day)
        .transform(with_avg_events_per_repo)
        .transform(stamp_build, run_at)
    )


# --- fact -----------------------------------------------------------------------------------------

# The columns of the fact.
FACT_COLUMNS = [
    "event_id",
    "event_date",
    "event_type",
    "created_at",
    "event_hour",
    "event_day_of_week",
    "event_year",
    "event_month",
    "event_day",
    "actor_id",
    "actor_login",
    "is_bot",
    "repo_id",
    "repo_name",
    "repo_owner",
    "repo_slug",
    "org_id",
    "org_login",
    "is_public",
    "payload",
    "source_file",
    "ingested_at",
]


def fact_join_repositories(
    events: DataFrame, repositories: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every event with its repository's owner and slug; NULL for events without a repository.

    Queries that use neither column do not pay for the join: Catalyst drops a left join whose
    right side is unique and unread.
    """
    return lookup_join(
        events, repositories, "repo_id", ["repo_owner", "repo_slug"], "total_events", "event_id", "left", hot_rows
    )


def fct_github_events(
    events: DataFrame, repositories: DataFrame, run_at: AsOf = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per staged event, 23 columns."""
    joined = fact_join_repositories(events, repositories, hot_rows)
    return joined.select(*FACT_COLUMNS).transform(stamp_build, run_at)


#: Up to this many corrections are broadcast: a few dozen bytes of text each, some 100 MB at worst.
BROADCAST_ROWS = 200_000


def repository_corrections(events: DataFrame, repositories: DataFrame) -> DataFrame:
    """Owner and slug of the repositories some of whose ``events`` carry another name, or none.

    For every other repository an event's own name already gives owner and slug.  Reads ids and names
    only; the result is about as large as the number of renames among ``events``.
    """
    used = entity_not_null(events, "repo_id").groupBy("repo_id", "repo_name").agg(F.count("*").alias("n"))
    known = repositories.select(
        F.col("repo_id"), F.col("repo_name").alias("current_name"), "repo_owner", "repo_slug"
    )
    return (
        used.join(known, "repo_id")
        .filter(~F.col("repo_name").eqNullSafe(F.col("current_name")))
        .select("repo_id", "repo_owner", "repo_slug")
        .distinct()
    )


def fct_from_own_names(events: DataFrame, corrections: DataFrame, run_at: AsOf = None) -> DataFrame:
    """The fact without moving an event: owner and slug from its own name, or from ``corrections``.

    ``corrections`` is broadcast; the caller has checked that it has at most BROADCAST_ROWS rows.
    """
    known = corrections.select(
        F.col("repo_id").alias("__id"), F.col("repo_owner").alias("__owner"), F.col("repo_slug").alias("__slug")
    )
    own = F.when(F.col("repo_id").isNotNull(), F.col("repo_name"))
    corrected = F.col("__id").isNotNull()
    return (
        events.join(F.broadcast(known), F.col("repo_id") == F.col("__id"), "left")
        .withColumns(
            {
                "repo_owner": F.when(corrected, F.col("__owner")).otherwise(repo_owner(own)),
                "repo_slug": F.when(corrected, F.col("__slug")).otherwise(repo_slug(own)),
            }
        )
        .select(*FACT_COLUMNS)
        .transform(stamp_build, run_at)
    )


# --- daily aggregates -------------------------------------------------------------------------------


def _bots_and_humans():
    return [
        F.count_if(F.col("is_bot")).alias("bot_events"),
        F.count_if(~F.col("is_bot")).alias("human_events"),
    ]


def agg_event_type_daily(fact: DataFrame, run_at: AsOf = None) -> DataFrame:
    """(event_date, event_type): events, distinct entities, bot / human and public / private split."""
    return (
        fact.groupBy("event_date", "event_type")
        .agg(
            F.count("*").alias("total_events"),
            F.count_distinct("actor_id").alias("unique_actors"),
            F.count_distinct("repo_id").alias("unique_repositories"),
            F.count_distinct("org_id").alias("unique_organizations"),
            *_bots_and_humans(),
            F.count_if(F.col("is_public")).alias("public_events"),
            F.count_if(~F.col("is_public")).alias("private_events"),
            distinct_hours().alias("distinct_hours_active"),
        )
        .transform(stamp_build, run_at)
    )


def agg_repository_daily(fact: DataFrame, run_at: AsOf = None) -> DataFrame:
    """(event_date, repo_id) for events with a repository."""
    keys, names = ["event_date", "repo_id"], ["repo_name", "repo_owner", "repo_slug"]
    events = fact.filter(F.col("repo_id").isNotNull())
    counted = events.groupBy(*keys).agg(
        F.count("*").alias("total_events"),
        F.count_distinct("actor_id").alias("unique_contributors"),
        F.count_distinct("event_type").alias("unique_event_types"),
        *pivot_event_types(REPOSITORY_TYPE_COLUMNS),
        *_bots_and_humans(),
    )
    return (
        with_names(counted, events, keys, names)
        .select(*keys, *names, *counted.columns[2:])
        .transform(stamp_build, run_at)
    )


def agg_actor_daily(fact: DataFrame, run_at: AsOf = None) -> DataFrame:
    """(event_date, actor_id)."""
    keys = ["event_date", "actor_id"]
    counted = fact.groupBy(*keys).agg(
        F.bool_or("is_bot").alias("is_bot"),
        F.count("*").alias("total_events"),
        F.count_distinct("repo_id").alias("unique_repositories"),
        F.count_distinct("event_type").alias("unique_event_types"),
        F.count_distinct("org_id").alias("unique_organizations"),
        *pivot_event_types(ACTOR_TYPE_COLUMNS),
        distinct_hours().alias("distinct_hours_active"),
    )
    return (
        with_names(counted, fact, keys, ["actor_login"])
        .select(*keys, "actor_login", *counted.columns[2:])
        .transform(stamp_build, run_at)
    )


# --- all models from one raw table ------------------------------------------------------------------


class Models:
    """All models over one raw DataFrame, linked lazily: reading one plans only what it needs."""

    def __init__(self, raw: DataFrame, run_at: AsOf = None):
        self.raw = raw
        self.run_at = run_at

    @cached_property
    def events(self) -> DataFrame:
        return staging.staging_events(self.raw)

    @cached_property
    def actors(self) -> DataFrame:
        return staging.stg_actors(self.events)

    @cached_property
    def repositories(self) -> DataFrame:
        return staging.stg_repositories(self.events)

    @cached_property
    def organizations(self) -> DataFrame:
        return staging.stg_organizations(self.events)

    @cached_property
    def dim_actors(self) -> DataFrame:
        return dim_actors(self.actors, self.run_at)

    @cached_property
    def dim_repositories(self) -> DataFrame:
        return dim_repositories(self.repositories, self.run_at)

    @cached_property
    def dim_organizations(self) -> DataFrame:
        return dim_organizations(self.organizations, self.run_at)

    @cached_property
    def fact(self) -> DataFrame:
        return fct_github_events(self.events, self.repositories, self.run_at)

    @cached_property
    def event_type_daily(self) -> DataFrame:
        return agg_event_type_daily(self.fact, self.run_at)

    @cached_property
    def repository_daily(self) -> DataFrame:
        return agg_repository_daily(self.fact, self.run_at)

    @cached_property
    def actor_daily(self) -> DataFrame:
        return agg_actor_daily(self.fact, self.run_at)
