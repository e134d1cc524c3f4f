"""Sources, sinks, projections, filters, upserts and joins."""

from .base import FLAT, NOW, RAW_COLUMNS, RELOAD, SHOWN, SIZES, actors_of, sql_map, tiers
from .loads import LINE, TRAILING

# The category lookup.
_SEEDS = """(values
 ('PushEvent', 'code', 'Push commits to a branch', true),
 ('PullRequestEvent', 'collaboration', 'Pull request opened/closed/merged', true),
 ('IssuesEvent', 'collaboration', 'Issue opened/closed/commented', false),
 ('IssueCommentEvent', 'collaboration', 'Comment on an issue', false),
 ('PullRequestReviewEvent', 'collaboration', 'Review submitted on PR', false),
 ('PullRequestReviewCommentEvent', 'collaboration', 'Comment on PR review', false),
 ('CreateEvent', 'repository', 'Branch or tag created', false),
 ('DeleteEvent', 'repository', 'Branch or tag deleted', false),
 ('ForkEvent', 'repository', 'Repository forked', false),
 ('WatchEvent', 'engagement', 'Repository starred', false),
 ('ReleaseEvent', 'repository', 'Release published', false),
 ('PublicEvent', 'repository', 'Repository made public', false),
 ('MemberEvent', 'collaboration', 'Collaborator added', false),
 ('CommitCommentEvent', 'collaboration', 'Comment on a commit', false),
 ('GollumEvent', 'documentation', 'Wiki page created or updated', false)
) as seeds(event_type, category, description, is_code_change)"""

_FACT_COLUMNS = """event_id, event_date, event_type, created_at, event_hour, event_day_of_week, event_year,
 event_month, event_day, actor_id, actor_login, is_bot, repo_id, repo_name, repo_owner, repo_slug, org_id,
 org_login, is_public, payload, source_file, ingested_at"""


def _after_upsert(new_payload: str) -> str:
    """Old rows before the 20th, new deliveries from the 10th on."""
    return f"""
select old.event_id,
 case when old.event_date >= DATE '2024-01-10' then new.event_type else old.event_type end as event_type,
 old.created_at, old.event_date, old.actor_id, old.actor_login, old.repo_id, old.repo_name, old.org_id,
 old.org_login, old.is_public,
 case when old.event_date >= {new_payload} then new.payload else old.payload end as payload,
 case when old.event_date >= DATE '2024-01-10' then new.source_file else old.source_file end as source_file,
 case when old.event_date >= DATE '2024-01-20' then {RELOAD} else old.ingested_at end as ingested_at,
 case when old.event_date >= DATE '2024-01-10' then {RELOAD} else old.updated_at end as updated_at
from raw old join redelivered new using (event_id)"""


def _show(condition: str, table: str = "raw") -> str:
    return f"select {SHOWN} from {table} where {condition}"


def _week_day(first: int) -> str:
    names = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    arms = " ".join(f"when {i + first} then '{name}'" for i, name in enumerate(names))
    return f"case event_day_of_week {arms} end"


WEEK_DAY = _week_day(1)

SQL = sql_map(
    # sources and sinks
    scan_event_files="""
select source_file, event_id as id, event_type as type, actor_login, repo_name, is_public, created_at
from raw""",
    reject_bad_lines=f"""
select 'trailing' as source_file, 'malformed' as reject_reason, md5({TRAILING}) as line_md5 from raw
union all
select 'doubled', 'malformed', md5({LINE} || {LINE}) from raw
union all
select 'documents' as source_file, 'malformed' as reject_reason, md5(text) as line_md5 from documents
union all
select 'props', 'incomplete', md5(props) from events""",
    flatten_events=f"""
select {FLAT}
from (select * replace (replace(payload, ' ', '') as payload, nullif(repo_id, '0') as repo_id) from raw)""",
    raw_sink=f"select {RAW_COLUMNS} from raw",
    scan_raw=f"select {RAW_COLUMNS} from raw",
    seed_event_categories=f"""
select seeds.*, (select count(*) from raw where raw.event_type = seeds.event_type) as events from {_SEEDS}""",
    table_sink="select * from dim_a",
    clustered_fact_sink=f"select {_FACT_COLUMNS} from fact",
    store_test_failures="""
select 'raw_events.not_null_actor_login' as test, count(*) as failing_rows from raw where actor_login is null
union all
select 'raw_events.accepted_event_type', count(*) from raw where event_type = 'DeleteEvent'
union all
select 'raw_events.unique_actor_id', count(*)
from (select actor_id from raw group by actor_id having count(*) > 1)""",
    legacy_nested_scan="""
select event_id as id, event_type as type, actor_login, repo_name, created_at from raw""",
    legacy_event_type_counts="select event_type as type, count(*) as events from raw group by event_type",
    # projections
    clean_projection=f"select {RAW_COLUMNS} from raw",
    bot_flag="""
select event_id, actor_login,
 actor_login is not null and (user_mod = 0 or user_mod = 1) as is_bot
from (select *, cast(actor_id as bigint) % 15 as user_mod from raw)""",
    time_dimensions="""
select event_id, created_at, cast(extract(hour from created_at) as int) as event_hour,
 cast(extract(dow from created_at) + 1 as int) as event_day_of_week,
 cast(extract(year from created_at) as int) as event_year,
 cast(extract(month from created_at) as int) as event_month,
 cast(extract(day from created_at) as int) as event_day
from raw""",
    split_repo_name="""
select event_id, repo_name, split_part(repo_name, '/', 1) as repo_owner,
 split_part(repo_name, '/', 2) as repo_slug
from raw""",
    activity_level=f"""
select actor_id, total_events,
 {tiers("total_events", [(85, "very_high"), (70, "high"), (55, "medium")], "low")} as activity_level
from stg_a""",
    popularity_tier=f"""
select repo_id, total_events,
 {tiers("total_events", [(60, "viral"), (30, "high"), (15, "medium")], "low")} as popularity_tier
from stg_r""",
    avg_events_per_day="select actor_id, total_events, active_days, avg_events_per_day from dim_a",
    contributor_diversity_pct="""
select repo_id, unique_contributors, total_events, contributor_diversity_pct from dim_r""",
    avg_events_per_repo="select org_id, total_events, total_repositories, avg_events_per_repo from dim_o",
    repo_count_bucket=f"""
select org_id, total_repositories, {tiers("total_repositories", SIZES, "1-9")} as repo_count_bucket
from stg_o""",
    contributor_type="""
select event_id, org_id, if(org_id is null, 'Individual', 'Organization') as contributor_type from raw""",
    day_name=f"""
select event_id, event_day_of_week, {_week_day(1)} as day_name, {_week_day(0)} as reference_day_name
from stg""",
    updated_at_stamp=f"select org_id, {NOW} as dbt_updated_at from dim_o",
    # filters
    quality_filter=_show("actor_login is not null"),
    exclude_event_types=_show("event_type <> 'DeleteEvent'"),
    entity_not_null=_show("repo_id is not null and repo_name is not null"),
    incremental_filter=_show(
        "event_date > (select max(event_date) from stg where event_date < DATE '2024-01-20')", "stg"
    ),
    incremental_filter_lookback=_show(
        "event_date > (select max(event_date) from stg where event_date < DATE '2024-01-20') - 7", "stg"
    ),
    trailing_days=_show("event_date >= DATE '2024-01-24'"),
    between_windows=_show("event_date between DATE '2024-01-17' and DATE '2024-01-23'"),
    event_type_in=_show("event_type in ('PushEvent', 'ForkEvent')"),
    exclude_bots=_show("not is_bot", "stg"),
    dashboard_filters=_show(
        "event_date between DATE '2024-01-05' and DATE '2024-01-25' "
        "and event_type in ('PushEvent', 'WatchEvent') and is_bot",
        "stg",
    ),
    expire_partitions=_show("event_date >= DATE '2024-01-17'"),
    # upsert, incremental, retention
    dedupe_batch=f"""
select {FLAT} from (select {FLAT} from raw union all select {FLAT} from redelivered union all select {FLAT} from raw)
qualify row_number() over (partition by event_id, event_date
                           order by source_file desc, created_at desc, payload desc) = 1""",
    upsert_raw=_after_upsert("DATE '2024-01-10'"),
    upsert_raw_keep_payload=_after_upsert("DATE '2024-01-20'"),
    incremental_merge="select * from type_daily",
    full_refresh="select * from dim_o",
    route_partitions="""
select o_orderkey, cast(o_orderdate as date) as event_date,
 if(year(o_orderdate) in (1995, 1996), strftime(o_orderdate, '%Y_%m'), 'default') as partition_name
from orders""",
    snapshot_scd2=f"""
, before as ({actors_of("(select * from stg where event_date < DATE '2024-01-16')")}),
versions as (
 select actor_id, actor_login, total_events, last_seen_at as updated_at from before
 union
 select actor_id, actor_login, total_events, last_seen_at from stg_a
)
select *, updated_at as valid_from,
 lead(updated_at) over (partition by actor_id order by updated_at) as valid_to
from versions""",
    snapshot_builds="""
, b(n, low, high, built) as (values
 (1, DATE '2000-01-01', DATE '2024-01-13', TIMESTAMP '2024-01-13 00:00:00'),
 (2, DATE '2024-01-08', DATE '2024-01-21', TIMESTAMP '2024-01-21 00:00:00'),
 (3, DATE '2024-01-16', DATE '2100-01-01', TIMESTAMP '2024-01-31 00:00:00')
),
states as (
 select n, concat(coalesce(repo_id, 'none'), '/', event_type) as entity, count(*) as n_events, max(created_at) as updated_at
 from stg join b on event_date >= low and event_date < high group by all
),
grid as (
 select k.entity, b.n, built, n_events, updated_at, lag(updated_at) over (partition by k.entity order by b.n) as before
 from (select distinct entity from states) k cross join b left join states s on s.entity = k.entity and s.n = b.n
),
marked as (
 select *, updated_at is not null and (before is null or updated_at > before) as opens,
  before is not null and (updated_at is null or updated_at > before) as closes, coalesce(updated_at, built) as changed_at
 from grid
),
versions as (
 select entity, n_events, updated_at, updated_at as valid_from, opens,
  min(case when closes then changed_at end) over (partition by entity order by n rows between 1 following and unbounded following) as valid_to
 from marked
)
select * exclude (opens), valid_to is null as is_open from versions where opens""",
    partition_life_cycle="""
select event_id, event_type, created_at, event_date, '2024_01' as partition_name, event_date as partition_date
from raw where event_date >= DATE '2024-01-17' and event_date < DATE '2024-01-20'
union all
select event_id, event_type, created_at, event_date, '2024_01', event_date from raw where event_date >= DATE '2024-01-17'
union all
select event_id, event_type, TIMESTAMP '1970-01-01 00:00:00', DATE '1970-01-01', 'default', null from raw""",
    merge_match="""
select event_id, event_date from raw
where event_date >= DATE '2024-01-10' and event_date < DATE '2024-01-20'""",
    # joins
    fact_join_repositories="select event_id, repo_id, repo_owner, repo_slug from fact",
    join_previous_period="""
, this_week as (
 select repo_id, count(*) as events from fact where event_date >= DATE '2024-01-24' group by repo_id
),
last_week as (
 select repo_id, count(*) as events from fact
 where event_date >= DATE '2024-01-17' and event_date < DATE '2024-01-24' group by repo_id
)
select t.repo_id, t.events as current_events, coalesce(l.events, 0) as previous_events
from this_week t left join last_week l using (repo_id) where t.repo_id is not null""",
    join_dimension="""
select repo_id, dim_r.repo_name, count(*) as current_events from fact join dim_r using (repo_id)
where event_date >= DATE '2024-01-24' group by all""",
    join_first_activity="""
select distinct actor_id, event_date, min(event_date) over (partition by actor_id) as first_seen from stg""",
    anti_join_orphans=f"""
select {SHOWN} from raw where actor_id not in (select cast(s_suppkey as varchar) from supplier)""",
    event_category_lookup=f"""
select event_id, raw.event_type, category, is_code_change
from raw left join (select * from {_SEEDS}) s on s.event_type = raw.event_type""",
)
