"""Dashboard cards, stated over the staged events wherever the mart is only a shortcut."""

from .base import NOW, SIZES, n, ratio, sql_map, tiers, total
from .rows import WEEK_DAY

_7 = "event_date >= DATE '2024-01-24'"
_30 = "event_date >= DATE '2024-01-01'"
_90 = "event_date >= DATE '2023-11-02'"


def _actors(alias: str, which: str = "true") -> str:
    return f"count(distinct actor_id) filter (where {which}) as {alias}"


SQL = sql_map(
    total_events_30d=f"select count(*) as total_events from stg where {_30}",
    active_developers_7d=f"select {_actors('active_developers', 'not is_bot')} from stg where {_7}",
    active_repos_7d=f"select count(distinct repo_id) as active_repos from stg where {_7}",
    total_organizations="select count(*) as total_orgs from stg_o",
    daily_event_trend_90d=f"select event_date, count(*) as total_events from stg where {_90} group by event_date",
    event_type_distribution_30d=f"""
, t as (select event_type, count(*) as events from stg where {_30} group by event_type)
select event_type, events, {ratio("events", "(select sum(events) from t)", 100)} as percentage
from t order by events desc, event_type limit 15""",
    bot_vs_human_trend_30d=f"""
select event_date, {n("is_bot", "bot_events")}, {n("not is_bot", "human_events")},
 {ratio("count(*) filter (where is_bot)", "count(*)", 100)} as bot_percentage
from stg where {_30} group by event_date""",
    active_users_trend_90d=f"""
select event_date, {_actors("unique_actors")}, {_actors("human_actors", "not is_bot")},
 {_actors("bot_actors", "is_bot")}
from stg where {_90} group by event_date""",
    public_vs_private_30d=f"""
select event_date, {n("is_public", "public_events")}, {n("not is_public", "private_events")}
from stg where {_30} group by event_date""",
    hourly_heatmap_30d=f"""
select event_hour, event_day_of_week, {WEEK_DAY} as day_name, count(*) as events
from stg where {_30} group by event_hour, event_day_of_week""",
    top_repositories_7d=f"""
select repo_name, {total("total_events")}, {total("unique_contributors", "contributors")},
 {total("push_events", "pushes")}, {total("pull_request_events", "pull_requests")},
 {total("issue_events", "issues")}
from repo_daily where {_7} group by repo_name order by 2 desc, 1 limit 20""",
    repository_growth_90d=f"""
select event_date, count(distinct repo_id) as active_repositories,
 count(distinct repo_id) filter (where is_public) as public_repos,
 count(distinct repo_id) filter (where not is_public) as private_repos
from stg where {_90} group by event_date""",
    popularity_distribution=f"""
select popularity_tier, count(*) as repository_count,
 {ratio("count(*)", "(select count(*) from dim_r)", 100)} as percentage
from dim_r group by popularity_tier""",
    activity_breakdown_30d=f"""
select event_date, {n("event_type = 'PushEvent'", "pushes")},
 {n("event_type = 'PullRequestEvent'", "pull_requests")}, {n("event_type = 'IssuesEvent'", "issues")}
from stg where {_30} and repo_id is not null group by event_date""",
    top_repo_owners=f"""
select split_part(repo_name, '/', 1) as repo_owner, count(distinct repo_id) as repositories,
 count(*) as total_events, {ratio("count(*)", "count(distinct repo_id)")} as avg_events_per_repo
from stg where repo_name is not null group by repo_owner order by total_events desc, repo_owner limit 20""",
    trending_repositories=f"""
, w as (
 select repo_id, {n(_7, "now_n")},
  {n("event_date >= DATE '2024-01-17' and event_date < DATE '2024-01-24'", "before_n")}
 from stg where repo_id is not null group by repo_id
)
select repo_name, now_n as current_week_events, before_n as previous_week_events, now_n - before_n as growth,
 {ratio("now_n - before_n", "before_n", 100)} as growth_percentage
from w join dim_r using (repo_id) where now_n >= 10 order by growth desc, repo_id limit 20""",
    top_developers_7d=f"""
select actor_login, {total("total_events")}, {total("unique_repositories", "repositories_contributed")},
 {total("unique_event_types", "event_variety")}
from actor_daily where {_7} and not is_bot group by actor_login order by 2 desc, 1 limit 50""",
    activity_level_distribution=f"""
select activity_level, count(*) as developer_count,
 {ratio("count(*)", "(select count(*) from dim_a where not is_bot)", 100)} as percentage
from dim_a where not is_bot group by activity_level""",
    daily_active_developers_90d=f"""
select event_date, {_actors("human_developers", "not is_bot")}, {_actors("bots", "is_bot")},
 {_actors("total_actors")}
from stg where {_90} group by event_date""",
    activity_by_hour_7d=f"""
select event_hour, count(*) as events, {_actors("unique_actors")}
from stg where {_7} and not is_bot group by event_hour""",
    activity_by_weekday_30d=f"""
select event_day_of_week, {WEEK_DAY} as day_name, count(*) as events, {_actors("unique_actors")}
from stg where {_30} and not is_bot group by event_day_of_week""",
    new_vs_returning_30d=f"""
, debut as (select actor_id, min(event_date) as first_day from stg group by actor_id)
select event_date, {_actors("new_developers", "first_day = event_date")},
 {_actors("returning_developers", "first_day < event_date")}
from stg join debut using (actor_id) where {_30} and not is_bot group by event_date""",
    top_organizations=f"""
select org_login, total_events, total_repositories, last_seen_at,
 cast(datepart('day', {NOW} - last_seen_at) as int) as days_since_activity
from stg_o order by total_events desc, org_id limit 25""",
    org_vs_individual_30d=f"""
select if(org_id is null, 'Individual', 'Organization') as contributor_type, count(*) as events,
 {_actors("unique_contributors")}, count(distinct repo_id) as unique_repositories
from stg where {_30} group by org_id is null""",
    org_activity_trend_90d=f"""
select event_date, count(distinct org_id) as active_organizations, count(org_id) as org_events
from stg where {_90} and org_id is not null group by event_date""",
    orgs_by_repo_count=f"""
select {tiers("total_repositories", SIZES, "1-9")} as repo_count_bucket, count(*) as organization_count
from stg_o group by repo_count_bucket""",
    event_type_trend_30d=f"""
select event_date, event_type, count(*) as events from stg
where {_30} and event_type in
 ('PushEvent', 'PullRequestEvent', 'IssuesEvent', 'WatchEvent', 'ForkEvent', 'CreateEvent')
group by event_date, event_type""",
    event_type_engagement_30d=f"""
, t as (
 select event_type, {total("total_events")}, {total("unique_actors")}, {total("unique_repositories")}
 from type_daily where {_30} group by event_type
)
select *, {ratio("total_events", "unique_actors")} as events_per_actor,
 {ratio("total_events", "unique_repositories")} as events_per_repo
from t""",
    hourly_by_event_type_7d=f"""
select event_hour, event_type, count(*) as events from stg
where {_7} and event_type in ('PushEvent', 'PullRequestEvent', 'IssuesEvent') group by event_hour, event_type""",
    data_freshness=f"""
, t as (
 select max(event_date) as latest_event_date, max(ingested_at) as latest_ingestion,
  count(distinct event_date) as days_available
 from stg
)
select *, cast(datepart('hour', {NOW} - latest_ingestion) as int) as hours_since_ingestion,
 cast(floor(date_diff('second', latest_ingestion, {NOW}) / 3600) as bigint) as total_hours
from t""",
    daily_record_counts_30d=f"select event_date, count(*) as record_count from stg where {_30} group by event_date",
    event_type_coverage="""
select event_type, count(*) as record_count, min(event_date) as first_seen, max(event_date) as last_seen,
 count(distinct event_date) as days_active
from stg group by event_type""",
    null_analysis_7d=f"""
select count(*) as total_records, count(*) - count(actor_id) as null_actor_id,
 count(*) - count(repo_id) as null_repo_id, count(*) - count(org_id) as null_org_id,
 {ratio("count(org_id)", "count(*)", 100)} as org_coverage_pct
from stg where {_7}""",
    latest_date_and_types="""
select max(event_date) as latest_date, count(distinct event_type) as event_types from raw""",
    raw_row_count="select count(*) as count from raw",
    event_type_counts_7d=f"select event_type, count(*) as event_count from stg where {_7} group by event_type",
    daily_trend_with_developers_90d=f"""
select event_date, count(*) as total_events, {_actors("unique_developers")}
from stg where {_90} group by event_date""",
    push_events_7d=f"select count(*) as count from stg where {_7} and event_type = 'PushEvent'",
)
