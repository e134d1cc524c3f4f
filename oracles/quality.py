"""Data tests."""

from .base import SHOWN, sql_map

# The event types in use.
_KNOWN = """'PushEvent', 'CreateEvent', 'IssuesEvent', 'IssueCommentEvent', 'PullRequestEvent',
 'PullRequestReviewEvent', 'PullRequestReviewCommentEvent', 'WatchEvent', 'ForkEvent', 'DeleteEvent',
 'ReleaseEvent', 'PublicEvent', 'MemberEvent', 'CommitCommentEvent', 'GollumEvent', 'DiscussionEvent'"""


def _gate() -> str:
    """Failure counts of the source and staging tests."""
    tests: list[tuple[str, str, str, str]] = []

    def add(table: str, source: str, name: str, failing: str) -> None:
        tests.append((f"{table}.{name}", source, failing, "count(*)"))

    def not_null(table: str, source: str, columns: str) -> None:
        for column in columns.split():
            add(table, source, f"not_null_{column}", f"{column} is null")

    def unique(table: str, source: str, name: str, columns: str) -> None:
        inner = f"(select {columns} from {source} group by {columns} having count(*) > 1)"
        tests.append((f"{table}.unique_{name}", inner, "true", "count(*)"))

    raw, events = "raw.github_events", "staging.stg_github_events"
    required = "event_id event_type created_at event_date is_public source_file ingested_at updated_at"
    not_null(raw, "raw", required)
    not_null(events, "stg", required + " actor_id actor_login is_bot")
    for flag in ("is_public", "is_bot"):
        add(events, "stg", f"accepted_values_{flag}", f"{flag} not in (true, false)")
    for column in ("event_id", "actor_login"):
        add(events, "stg", f"not_empty_{column}", f"trim({column}) = ''")
    add(events, "stg", "accepted_values_event_type", f"event_type not in ({_KNOWN})")
    add(events, "stg", "between_created_at", "created_at not between '2015-01-01' and TIMESTAMP '2024-01-26'")
    add(events, "stg", "length_repo_name", "length(repo_name) not between 3 and 255")
    add(events, "stg", "between_event_hour", "event_hour not between 0 and 23")
    add(events, "stg", "between_event_day_of_week", "event_day_of_week not between 1 and 7")
    late = "created_at > TIMESTAMP '2024-01-25' or event_date > DATE '2024-01-25'"
    add(events, "stg", "no_future_events", late)
    add(events, "stg", "event_date_matches_created_at", "event_date <> created_at::date")
    unique(events, "stg", "event_id_event_date", "event_id, event_date")
    add(events, "stg", "type_event_date", "typeof(event_date) <> 'DATE'")

    span = " first_seen_at last_seen_at total_events"
    for table, source, key, name, more in [
        ("staging.stg_actors", "stg_a", "actor_id", "actor_login", " is_bot"),
        ("staging.stg_repositories", "stg_r", "repo_id", "repo_name", " repo_owner repo_slug is_public is_org_owned"),
        ("staging.stg_organizations", "stg_o", "org_id", "org_login", " total_repositories"),
    ]:
        not_null(table, source, f"{key} {name}{more}{span}")
        for flag in [c for c in more.split() if c.startswith("is_")]:
            add(table, source, f"accepted_values_{flag}", f"{flag} not in (true, false)")
        add(table, source, "between_total_events", "total_events < 1")
        add(table, source, f"not_empty_{name}", f"trim({name}) = ''")
        unique(table, source, key, key)
    add("staging.stg_organizations", "stg_o", "between_total_repositories", "total_repositories < 1")
    return "\nunion all\n".join(
        f"select '{test}' as test, {count} as failures from {source} where {failing}"
        for test, source, failing, count in tests
    )


_CONSTRAINTS = """
, damaged as (
 select event_id, created_at, cast(ingested_at as date) as event_date, event_type = 'DeleteEvent' as blank
 from raw
)
select event_id, event_date, 'event_type_not_empty' as rule from damaged where blank
union all
select event_id, event_date, 'event_date_matches_created_at' from damaged
where event_date <> cast(created_at as date)"""

SQL = sql_map(
    test_not_null=f"select {SHOWN} from raw where actor_login is null",
    test_unique="select actor_id, count(*) as n_records from raw group by actor_id having n_records > 1",
    test_unique_combination="""
select event_date, actor_id, count(*) as n_records from raw group by event_date, actor_id having n_records > 1""",
    test_accepted_values=f"select {SHOWN} from raw where event_type = 'DeleteEvent'",
    test_not_empty_string="""
select event_id, '' as org_slug from raw where org_login is not null""",
    test_column_type="""
select 'created_at' as column_name, 'date' as expected_type, 'timestamp' as actual_type,
 count(*) as rows_affected
from raw""",
    test_between="select event_id, event_hour from stg where event_hour < 6 or event_hour > 18",
    test_length_between="""
select event_id, repo_name from raw where length(repo_name) < 3 or length(repo_name) > 13""",
    test_no_future_events="""
select event_id, created_at, event_date from raw where created_at > TIMESTAMP '2024-01-25 00:00:00'""",
    test_positive_counts="""
select event_date, actor_id, total_events from actor_daily
where total_events <= 0 or unique_repositories <= 0""",
    test_event_date_matches="""
select event_id, event_date, ingested_at as created_at, cast(ingested_at as date) as created_date
from raw where event_date <> cast(ingested_at as date)""",
    test_no_orphans="""
select actor_id, count(*) as orphan_rows from raw
where actor_id is not null and actor_id not in (select cast(s_suppkey as varchar) from supplier) group by actor_id""",
    test_recency="""
, t as (
 select max(created_at) as latest_timestamp,
  cast(DATE '2024-02-15' - cast(max(created_at) as date) as int) as days_since_latest
 from raw
)
select * from t where days_since_latest > 7""",
    source_freshness="""
, t as (
 select max(ingested_at) as max_loaded_at,
  cast(epoch(TIMESTAMP '2024-01-31 05:30:00') - floor(epoch(max(ingested_at))) as bigint) as age_seconds
 from raw
)
select *, case when age_seconds <= 10800 then 'pass' when age_seconds <= 21600 then 'warn' else 'error' end as status
from t""",
    check_constraints=_CONSTRAINTS,
    stored_failures="""
select 'staging.stg_github_events.no_future_events' as test, event_id, created_at, event_date, is_bot, true as stops_the_build
from stg where created_at > TIMESTAMP '2024-01-25 00:00:00'
union all
select 'staging.stg_github_events.between_created_at', event_id, created_at, event_date, is_bot, true
from stg where created_at > TIMESTAMP '2024-01-26 00:00:00'""",
    quality_gate=_gate(),
)
