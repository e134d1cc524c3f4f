"""The data tests attached to each layer's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_of_date, as_of_timestamp
from ..functions.calendar import AsOf
from ..operators.checks import (
    Suite,
    check_column_type,
    check_positive_counts,
    date_differs,
    in_future,
    is_blank,
    is_missing,
    not_accepted,
    outside,
)
from ..operators.joins import orphan_values
from ..schemas import ACCEPTED_EVENT_TYPES, RAW_KEY, RAW_REQUIRED


def _not_null(*columns: str) -> dict:
    return {f"not_null_{c}": is_missing(c) for c in columns}


def _booleans(*columns: str) -> dict:
    return {f"accepted_values_{c}": not_accepted(c, [True, False]) for c in columns}


def source_suite(raw: DataFrame) -> Suite:
    return Suite("raw.github_events", raw, _not_null(*RAW_REQUIRED))


def staging_suites(
    events: DataFrame,
    actors: DataFrame,
    repositories: DataFrame,
    organizations: DataFrame,
    as_of: AsOf = None,
) -> list[Suite]:
    tomorrow = F.timestamp_seconds((F.unix_date(as_of_date(as_of)).cast("long") + 1) * 86_400)
    event_rows = {
        **_not_null(
            *RAW_KEY,
            "event_type",
            "created_at",
            "actor_id",
            "actor_login",
            "is_public",
            "source_file",
            "ingested_at",
            "updated_at",
            "is_bot",
        ),
        **_booleans("is_public", "is_bot"),
        "not_empty_event_id": is_blank("event_id"),
        "not_empty_actor_login": is_blank("actor_login"),
        "accepted_values_event_type": not_accepted("event_type", ACCEPTED_EVENT_TYPES),
        "between_created_at": outside("created_at", as_of_timestamp("2015-01-01"), tomorrow),
        "length_repo_name": outside(F.length("repo_name"), 3, 255),
        "between_event_hour": outside("event_hour", 0, 23),
        "between_event_day_of_week": outside("event_day_of_week", 1, 7),
        "no_future_events": in_future(as_of),
        "event_date_matches_created_at": date_differs(),
    }
    timeline = ["first_seen_at", "last_seen_at", "total_events"]
    positive = {"between_total_events": outside("total_events", 1)}
    return [
        Suite(
            "staging.stg_github_events",
            events,
            event_rows,
            {"unique_event_id_event_date": RAW_KEY},
            {"type_event_date": check_column_type(events, "event_date", "date")},
        ),
        Suite(
            "staging.stg_actors",
            actors,
            {
                **_not_null("actor_id", "actor_login", "is_bot", *timeline),
                **_booleans("is_bot"),
                **positive,
                "not_empty_actor_login": is_blank("actor_login"),
            },
            {"unique_actor_id": ["actor_id"]},
        ),
        Suite(
            "staging.stg_repositories",
            repositories,
            {
                **_not_null(
                    "repo_id", "repo_name", "repo_owner", "repo_slug", "is_public", "is_org_owned", *timeline
                ),
                **_booleans("is_public", "is_org_owned"),
                **positive,
                "not_empty_repo_name": is_blank("repo_name"),
            },
            {"unique_repo_id": ["repo_id"]},
        ),
        Suite(
            "staging.stg_organizations",
            organizations,
            {
                **_not_null("org_id", "org_login", "total_repositories", *timeline),
                **positive,
                "between_total_repositories": outside("total_repositories", 1),
                "not_empty_org_login": is_blank("org_login"),
            },
            {"unique_org_id": ["org_id"]},
        ),
    ]


def reference_suite(
    fact: DataFrame, actors: DataFrame, repositories: DataFrame, organizations: DataFrame
) -> Suite:
    """Orphan tests of the fact.  They warn and gate no build: an event may name no repository."""
    references = {
        "no_orphan_actor_id": orphan_values(fact, "actor_id", actors, "actor_id"),
        "no_orphan_repo_id": orphan_values(fact, "repo_id", repositories, "repo_id"),
        "no_orphan_org_id": orphan_values(fact, "org_id", organizations, "org_id"),
    }
    return Suite("marts.fct_github_events", fact, {}, other=references)


def marts_suites(
    fact: DataFrame,
    actors: DataFrame,
    repositories: DataFrame,
    organizations: DataFrame,
    type_daily: DataFrame,
    repository_daily: DataFrame,
    actor_daily: DataFrame,
) -> list[Suite]:
    return [
        Suite("marts.fct_github_events", fact, _not_null(*RAW_KEY, "event_type", "created_at")),
        Suite("marts.dim_actors", actors, _not_null("actor_id", "actor_login"), {"unique_actor_id": ["actor_id"]}),
        Suite(
            "marts.dim_repositories",
            repositories,
            _not_null("repo_id", "repo_name"),
            {"unique_repo_id": ["repo_id"]},
        ),
        Suite(
            "marts.dim_organizations",
            organizations,
            _not_null("org_id", "org_login"),
            {"unique_org_id": ["org_id"], "unique_org_login": ["org_login"]},
        ),
        Suite(
            "marts.agg_event_type_daily",
            type_daily,
            _not_null("event_date", "event_type"),
            other={"positive_counts": check_positive_counts(type_daily)},
        ),
        Suite("marts.agg_repository_daily", repository_daily, _not_null("event_date", "repo_id")),
        Suite("marts.agg_actor_daily", actor_daily, _not_null("event_date", "actor_id")),
    ]
