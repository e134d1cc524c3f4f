"""Dashboard cards over the marts.

Every card takes the mart it reads, an ``as_of`` date in place of "today", and the window, limit and
optional columns in which dashboards differ.  Top-k results break ties by the group key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_of_date, as_of_timestamp, bucket, contributor_type, day_name, percent, ratio, utc_date
from ..functions.calendar import AsOf
from ..operators.aggregates import conditional_distinct, group_by_expression
from ..operators.filters import (
    dashboard_filters,
    entity_not_null,
    event_type_in,
    exclude_bots,
    trailing_days,
)
from ..operators.joins import compare_periods, join_dimension, join_first_seen
from ..operators.ranking import order_by_case, pct_of_total, top_k
from ..schemas import HOURLY_EVENT_TYPES, REPO_COUNT_BUCKETS, TREND_EVENT_TYPES

TIER_ORDER = ["viral", "high", "medium", "low"]
LEVEL_ORDER = ["very_high", "high", "medium", "low"]


def _count(alias: str) -> Column:
    return F.count("*").alias(alias)


def _sums(**columns: str) -> list[Column]:
    """``alias="column"`` -> sum(column) AS alias."""
    return [F.sum(column).alias(alias) for alias, column in columns.items()]


# --- activity overview ------------------------------------------------------------------------------


def total_events(fact: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    return trailing_days(fact, days, as_of).agg(_count("total_events"))


def active_developers(fact: DataFrame, as_of: AsOf = None, days: int = 7) -> DataFrame:
    humans = exclude_bots(trailing_days(fact, days, as_of))
    return humans.agg(F.count_distinct("actor_id").alias("active_developers"))


def active_repos(fact: DataFrame, as_of: AsOf = None, days: int = 7) -> DataFrame:
    return trailing_days(fact, days, as_of).agg(F.count_distinct("repo_id").alias("active_repos"))


def total_organizations(organizations: DataFrame) -> DataFrame:
    return entity_not_null(organizations, "org_login").agg(_count("total_orgs"))


def daily_event_trend(fact: DataFrame, as_of: AsOf = None, days: int = 90) -> DataFrame:
    recent = trailing_days(fact, days, as_of)
    return recent.groupBy("event_date").agg(_count("total_events")).orderBy("event_date")


def event_type_distribution(
    type_daily: DataFrame, as_of: AsOf = None, days: int = 30, limit: int = 15
) -> DataFrame:
    """Events and share of all events per type; the share counts types beyond the limit too."""
    grouped = trailing_days(type_daily, days, as_of).groupBy("event_type").agg(*_sums(events="total_events"))
    return top_k(pct_of_total(grouped, "events"), "events", limit, "event_type")


def bot_vs_human_trend(
    type_daily: DataFrame, as_of: AsOf = None, days: int = 30, include_percentage: bool = True
) -> DataFrame:
    daily = (
        trailing_days(type_daily, days, as_of)
        .groupBy("event_date")
        .agg(*_sums(bot_events="bot_events", human_events="human_events", total="total_events"))
    )
    if include_percentage:
        daily = daily.withColumn("bot_percentage", percent("bot_events", "total"))
    return daily.drop("total").orderBy("event_date")


def active_users_trend(fact: DataFrame, as_of: AsOf = None, days: int = 90) -> DataFrame:
    """Per date, distinct actors, and those seen as a human and as a bot."""
    return conditional_distinct(
        trailing_days(fact, days, as_of),
        ["event_date"],
        "actor_id",
        {"unique_actors": None, "human_actors": ~F.col("is_bot"), "bot_actors": F.col("is_bot")},
    ).orderBy("event_date")


def public_vs_private(type_daily: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    return (
        trailing_days(type_daily, days, as_of)
        .groupBy("event_date")
        .agg(*_sums(public_events="public_events", private_events="private_events"))
        .orderBy("event_date")
    )


def hourly_heatmap(
    fact: DataFrame,
    as_of: AsOf = None,
    days: int = 30,
    include_day_name: bool = True,
    label_mode: str = "calendar",
) -> DataFrame:
    cells = (
        trailing_days(fact, days, as_of).groupBy("event_hour", "event_day_of_week").agg(_count("events"))
    )
    names = [day_name("event_day_of_week", label_mode).alias("day_name")] if include_day_name else []
    return cells.select("event_hour", "event_day_of_week", *names, "events").orderBy(
        "event_day_of_week", "event_hour"
    )


# --- repositories -----------------------------------------------------------------------------------


def top_repositories(
    repository_daily: DataFrame,
    as_of: AsOf = None,
    days: int = 7,
    limit: int = 20,
    include_issues: bool = True,
) -> DataFrame:
    """Most active repositories.  ``contributors`` adds up daily counts: a person counts once a day."""
    sums = _sums(
        total_events="total_events",
        contributors="unique_contributors",
        pushes="push_events",
        pull_requests="pull_request_events",
    )
    if include_issues:
        sums += _sums(issues="issue_events")
    grouped = trailing_days(repository_daily, days, as_of).groupBy("repo_name").agg(*sums)
    return top_k(grouped, "total_events", limit, "repo_name")


def repository_growth(fact: DataFrame, as_of: AsOf = None, days: int = 90) -> DataFrame:
    """Per date, distinct repositories, and those with public and with private events."""
    public = F.col("is_public")
    return conditional_distinct(
        trailing_days(fact, days, as_of),
        ["event_date"],
        "repo_id",
        {"active_repositories": None, "public_repos": public, "private_repos": ~public},
    ).orderBy("event_date")


def popularity_distribution(repositories: DataFrame) -> DataFrame:
    grouped = repositories.groupBy("popularity_tier").agg(_count("repository_count"))
    return order_by_case(pct_of_total(grouped, "repository_count"), "popularity_tier", TIER_ORDER)


def activity_breakdown(repository_daily: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    return (
        trailing_days(repository_daily, days, as_of)
        .groupBy("event_date")
        .agg(*_sums(pushes="push_events", pull_requests="pull_request_events", issues="issue_events"))
        .orderBy("event_date")
    )


def top_repo_owners(repositories: DataFrame, limit: int = 20, include_average: bool = True) -> DataFrame:
    """Owners by events.  The dimension has one row per repository, so rows count repositories."""
    owners = repositories.groupBy("repo_owner").agg(
        F.count("repo_id").alias("repositories"), *_sums(total_events="total_events")
    )
    if include_average:
        owners = owners.withColumn("avg_events_per_repo", ratio("total_events", "repositories"))
    return top_k(owners, "total_events", limit, "repo_owner")


def trending_repositories(
    repository_daily: DataFrame,
    repositories: DataFrame,
    as_of: AsOf = None,
    days: int = 7,
    min_events: int = 10,
    limit: int = 20,
) -> DataFrame:
    """This period against the one before, by growth; growth_percentage is NULL for new ones."""
    today, date = as_of_date(as_of), F.col("event_date")
    current = date >= F.date_sub(today, days)
    previous = (date >= F.date_sub(today, 2 * days)) & (date < F.date_sub(today, days))
    periods = compare_periods(repository_daily, "repo_id", "total_events", current, previous)
    active = periods.filter(F.col("current_events") >= min_events)
    before = F.coalesce(F.col("previous_events"), F.lit(0))
    growth = F.col("current_events") - before
    rows = join_dimension(active, repositories, "repo_id", ["repo_name"]).select(
        "repo_id",
        "repo_name",
        F.col("current_events").alias("current_week_events"),
        before.alias("previous_week_events"),
        growth.alias("growth"),
        percent(growth, "previous_events").alias("growth_percentage"),
    )
    return top_k(rows, "growth", limit, "repo_id").drop("repo_id")


# --- developers -------------------------------------------------------------------------------------


def top_developers(
    actor_daily: DataFrame, as_of: AsOf = None, days: int = 7, limit: int = 50
) -> DataFrame:
    """Most active humans; the two variety columns add up daily distinct counts."""
    grouped = (
        exclude_bots(trailing_days(actor_daily, days, as_of))
        .groupBy("actor_login")
        .agg(
            *_sums(
                total_events="total_events",
                repositories_contributed="unique_repositories",
                event_variety="unique_event_types",
            )
        )
    )
    return top_k(grouped, "total_events", limit, "actor_login")


def activity_level_distribution(actors: DataFrame) -> DataFrame:
    grouped = exclude_bots(actors).groupBy("activity_level").agg(_count("developer_count"))
    return order_by_case(pct_of_total(grouped, "developer_count"), "activity_level", LEVEL_ORDER)


def daily_active_developers(fact: DataFrame, as_of: AsOf = None, days: int = 90) -> DataFrame:
    return conditional_distinct(
        trailing_days(fact, days, as_of),
        ["event_date"],
        "actor_id",
        {"human_developers": ~F.col("is_bot"), "bots": F.col("is_bot"), "total_actors": None},
    ).orderBy("event_date")


def activity_by_hour(
    fact: DataFrame, as_of: AsOf = None, days: int = 7, bots: str = "none"
) -> DataFrame:
    recent = dashboard_filters(trailing_days(fact, days, as_of), bots=bots)
    return (
        recent.groupBy("event_hour")
        .agg(_count("events"), F.count_distinct("actor_id").alias("unique_actors"))
        .orderBy("event_hour")
    )


def activity_by_weekday(
    fact: DataFrame,
    as_of: AsOf = None,
    days: int = 30,
    bots: str = "none",
    label_mode: str = "calendar",
) -> DataFrame:
    recent = dashboard_filters(trailing_days(fact, days, as_of), bots=bots)
    return (
        recent.groupBy("event_day_of_week")
        .agg(_count("events"), F.count_distinct("actor_id").alias("unique_actors"))
        .select(
            "event_day_of_week",
            day_name("event_day_of_week", label_mode).alias("day_name"),
            "events",
            "unique_actors",
        )
        .orderBy("event_day_of_week")
    )


def new_vs_returning(
    fact: DataFrame, as_of: AsOf = None, days: int = 30, actors: DataFrame | None = None
) -> DataFrame:
    """Per date, humans first seen that day and humans seen before; first seen over all history.

    The fact is reduced to (actor, date) pairs first.  Actors are unique within a date by then, so the
    distinct counts are plain counts.  With ``actors`` (the actor dimension of the same events), only the
    window's dates of the fact are read and joined to it; without, first dates come from all history.
    """
    source = fact if actors is None else trailing_days(fact, days, as_of)
    pairs = source.groupBy("actor_id", "event_date").agg(F.bool_or(~F.col("is_bot")).alias("human"))
    pairs = pairs.filter(F.col("actor_id").isNotNull())
    if actors is None:
        seen = trailing_days(join_first_seen(pairs, "actor_id"), days, as_of)
    else:
        seen = pairs.join(actors.select("actor_id", utc_date("first_seen_at").alias("first_seen")), "actor_id")
    return (
        seen.filter("human")
        .groupBy("event_date")
        .agg(
            F.count_if(F.col("first_seen") == F.col("event_date")).alias("new_developers"),
            F.count_if(F.col("first_seen") < F.col("event_date")).alias("returning_developers"),
        )
        .orderBy("event_date")
    )


# --- organizations ----------------------------------------------------------------------------------


def top_organizations(
    organizations: DataFrame, as_of: AsOf = None, limit: int = 25, include_last_seen: bool = True
) -> DataFrame:
    age = F.date_part(F.lit("DAY"), as_of_timestamp(as_of) - F.col("last_seen_at"))
    rows = entity_not_null(organizations, "org_login").select(
        "org_id",
        "org_login",
        "total_events",
        "total_repositories",
        *(["last_seen_at"] if include_last_seen else []),
        age.cast("int").alias("days_since_activity"),
    )
    return top_k(rows, "total_events", limit, "org_id").drop("org_id")


def org_vs_individual(fact: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    return group_by_expression(
        trailing_days(fact, days, as_of),
        contributor_type(),
        "contributor_type",
        [
            _count("events"),
            F.count_distinct("actor_id").alias("unique_contributors"),
            F.count_distinct("repo_id").alias("unique_repositories"),
        ],
    )


def org_activity_trend(fact: DataFrame, as_of: AsOf = None, days: int = 90) -> DataFrame:
    in_org = entity_not_null(trailing_days(fact, days, as_of), "org_id")
    return (
        in_org.groupBy("event_date")
        .agg(F.count_distinct("org_id").alias("active_organizations"), _count("org_events"))
        .orderBy("event_date")
    )


def orgs_by_repo_count(organizations: DataFrame) -> DataFrame:
    """Organizations per size bucket, largest sizes first."""
    return group_by_expression(
        organizations,
        bucket("total_repositories", REPO_COUNT_BUCKETS, "1-9"),
        "repo_count_bucket",
        [_count("organization_count")],
        order=F.min("total_repositories"),
    )


# --- event types ------------------------------------------------------------------------------------


def event_type_trend(
    type_daily: DataFrame,
    as_of: AsOf = None,
    days: int = 30,
    types: Sequence[str] = TREND_EVENT_TYPES,
) -> DataFrame:
    return (
        event_type_in(trailing_days(type_daily, days, as_of), types)
        .groupBy("event_date", "event_type")
        .agg(*_sums(events="total_events"))
        .orderBy("event_date", "event_type")
    )


def event_type_engagement(type_daily: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """Totals per type and events per (daily distinct) actor and repository."""
    totals = (
        trailing_days(type_daily, days, as_of)
        .groupBy("event_type")
        .agg(
            *_sums(
                total_events="total_events",
                unique_actors="unique_actors",
                unique_repositories="unique_repositories",
            )
        )
    )
    return totals.withColumns(
        {
            "events_per_actor": ratio("total_events", "unique_actors"),
            "events_per_repo": ratio("total_events", "unique_repositories"),
        }
    ).orderBy(F.desc("total_events"), "event_type")


def hourly_by_event_type(
    fact: DataFrame, as_of: AsOf = None, days: int = 7, types: Sequence[str] = HOURLY_EVENT_TYPES
) -> DataFrame:
    return (
        event_type_in(trailing_days(fact, days, as_of), types)
        .groupBy("event_hour", "event_type")
        .agg(_count("events"))
        .orderBy("event_hour", "event_type")
    )


# --- data quality -----------------------------------------------------------------------------------


def data_freshness(fact: DataFrame, as_of: AsOf = None, include_days_available: bool = True) -> DataFrame:
    """Newest date and load.  ``hours_since_ingestion`` is the hour field of the age (0-23), as on
    the original card; ``total_hours`` is the whole age in hours."""
    extra = [F.count_distinct("event_date").alias("days_available")] if include_days_available else []
    newest = fact.agg(
        F.max("event_date").alias("latest_event_date"), F.max("ingested_at").alias("latest_ingestion"), *extra
    )
    now = as_of_timestamp(as_of)
    seconds = F.unix_timestamp(now) - F.unix_timestamp("latest_ingestion")
    return newest.withColumns(
        {
            "hours_since_ingestion": F.date_part(F.lit("HOUR"), now - F.col("latest_ingestion")).cast("int"),
            "total_hours": F.floor(seconds / 3600).cast("long"),
        }
    )


def daily_record_counts(fact: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    recent = trailing_days(fact, days, as_of)
    return recent.groupBy("event_date").agg(_count("record_count")).orderBy("event_date")


def event_type_coverage(fact: DataFrame, include_days_active: bool = True) -> DataFrame:
    """Per type, rows and first / last date.  Rolled up from (type, date), so days are plain rows."""
    by_day = fact.groupBy("event_type", "event_date").agg(_count("n"))
    extra = [F.count("event_date").alias("days_active")] if include_days_active else []
    return (
        by_day.groupBy("event_type")
        .agg(
            F.sum("n").alias("record_count"),
            F.min("event_date").alias("first_seen"),
            F.max("event_date").alias("last_seen"),
            *extra,
        )
        .orderBy(F.desc("record_count"), "event_type")
    )


def null_analysis(fact: DataFrame, as_of: AsOf = None, days: int = 7) -> DataFrame:
    """Missing ids and the share of rows with an organization; the share is NULL without rows."""
    missing = lambda c: F.count_if(F.col(c).isNull()).alias(f"null_{c}")
    return (
        trailing_days(fact, days, as_of)
        .agg(_count("total_records"), missing("actor_id"), missing("repo_id"), missing("org_id"))
        .withColumn(
            "org_coverage_pct", percent(F.col("total_records") - F.col("null_org_id"), "total_records")
        )
    )


# --- other documented queries -----------------------------------------------------------------------


def latest_date_and_types(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.max("event_date").alias("latest_date"), F.count_distinct("event_type").alias("event_types")
    )


def raw_row_count(raw: DataFrame) -> DataFrame:
    return raw.agg(_count("count"))


def event_type_counts(fact: DataFrame, as_of: AsOf = None, days: int = 7) -> DataFrame:
    recent = trailing_days(fact, days, as_of)
    return recent.groupBy("event_type").agg(_count("event_count")).orderBy(F.desc("event_count"), "event_type")


def daily_trend_with_developers(fact: DataFrame, as_of: AsOf = None, days: int = 90) -> DataFrame:
    return (
        trailing_days(fact, days, as_of)
        .groupBy("event_date")
        .agg(_count("total_events"), F.count_distinct("actor_id").alias("unique_developers"))
        .orderBy("event_date")
    )


def events_of_type(
    fact: DataFrame, event_type: str = "PushEvent", as_of: AsOf = None, days: int = 7
) -> DataFrame:
    return event_type_in(trailing_days(fact, days, as_of), [event_type]).agg(_count("count"))
