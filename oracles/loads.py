"""Load planning and audit."""

from .base import NOW, sql_map

_HOUR = "strftime(h, '%Y-%m-%d-') || cast(hour(h) as varchar)"
_HOURS = """
, hours as (
 select unnest(generate_series(min(date_trunc('hour', created_at)), max(date_trunc('hour', created_at)),
                               interval 1 hour)) as h
 from raw
)"""
_AROUND = _HOURS.replace("min(date_trunc('hour', created_at))", "min(date_trunc('hour', created_at)) - interval 24 hour").replace(
    "max(date_trunc('hour', created_at))", "max(date_trunc('hour', created_at)) + interval 24 hour"
)
#: An event line spelled out as text: absent values have no key at all.
LINE = """
 '{"id":"' || event_id || '","type":"' || event_type || '","actor":{"id":' || actor_id
 || coalesce(',"login":"' || actor_login || '"', '') || '},"repo":{'
 || coalesce('"id":' || repo_id || ',"name":"' || repo_name || '"', '') || '}'
 || coalesce(',"org":{"id":' || org_id || ',"login":"' || org_login || '"}', '')
 || ',"payload":' || replace(payload, ' ', '') || ',"public":' || cast(is_public as varchar)
 || ',"created_at":"' || strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}'"""

def _entities(model: str, daily: bool, key: str, name: str, first: str, second: str, where: str = "true") -> str:
    """One model after the three loads: the name from a ranking, distinct values counted one by one."""
    by = f"event_date, {key}" if daily else key
    picked = f"""
  select {by}, {name} as entity_name from changed where {where} and {name} is not null
  qualify row_number() over (partition by {by} order by {name} desc) = 1"""
    values = lambda c: f"select {by}, count(*) as n from (select distinct {by}, {c} from changed where {where} and {c} is not null) group by {by}"
    using = "event_date, k" if daily else "k"
    renamed = lambda q: f"(select {'event_date, ' if daily else ''}{key} as k, * exclude ({by}) from ({q}))"
    counted = f"""select {by}, count(*) as total_events, min(created_at) as first_seen_at, max(created_at) as last_seen_at
  from changed where {where} group by {by}"""
    seen = "null::bigint as active_days, null::timestamp as first_seen_at, null::timestamp as last_seen_at"
    if not daily:
        seen = "d.n as active_days, first_seen_at, last_seen_at"
    return f"""
 select '{model}' as model, {"event_date" if daily else "null::date as event_date"}, k as entity_id, entity_name, total_events,
  coalesce(a.n, 0) as distinct_1, coalesce(b.n, 0) as distinct_2, {seen}
 from {renamed(counted)} left join {renamed(picked)} using ({using})
  left join {renamed(values(first))} a using ({using}) left join {renamed(values(second))} b using ({using})
  {"" if daily else f"left join {renamed(values('event_date'))} d using (k)"}"""


_INCREMENTAL = f"""
, updated as (select * replace (case when event_date = DATE '2024-01-22' then 'DeleteEvent' else event_type end as event_type) from raw),
changed as (select * from updated where actor_login is not null and event_type <> 'DeleteEvent')
{_entities("staging.stg_actors", False, "actor_id", "actor_login", "repo_id", "event_type")}
union all {_entities("staging.stg_repositories", False, "repo_id", "repo_name", "actor_id", "event_type", "repo_id is not null and repo_name is not null")}
union all {_entities("staging.stg_organizations", False, "org_id", "org_login", "repo_id", "actor_id", "org_id is not null and org_login is not null")}
union all {_entities("marts.agg_repository_daily", True, "repo_id", "repo_name", "actor_id", "event_type", "repo_id is not null")}
union all {_entities("marts.agg_actor_daily", True, "actor_id", "actor_login", "repo_id", "event_type")}
union all select * replace (null::varchar as entity_name) from ({_entities("marts.agg_event_type_daily", True, "event_type", "event_type", "actor_id", "repo_id")})"""


#: The same with one of six things after it.
TRAILING = f"""{LINE} || [' trailing', ',"x":1', ',"__end":true', ']}}', ',{{"__end":""}}', ',"__line":[' || {LINE}]
 [length({LINE}) % 6 + 1]"""

SQL = sql_map(
    incremental_build=_INCREMENTAL,
    load_audit=f"""
select source_file, 'raw.github_events' as table_name, count(*) as rows_inserted, 0::bigint as rows_failed,
 cast(sum(octet_length(encode({LINE})) + 1) as bigint) as bytes_processed, true as success, {NOW} as loaded_at, false as has_error
from raw group by source_file
union all select '2024-02-01-0.json.gz', 'raw.github_events', 0, 0, 0, false, {NOW}, true""",
    hours_to_process=f"{_HOURS} select h as hour, {_HOUR} as date_hour from hours",
    last_processed_hour="""
select source_file, strptime(replace(source_file, '.json.gz', ''), '%Y-%m-%d-%H') as last_hour
from raw order by created_at desc, source_file desc limit 1""",
    load_range="""
select date_trunc('hour', max(created_at)) + interval 1 hour as start_hour,
 TIMESTAMP '2024-02-01 04:00:00' as end_hour
from raw""",
    missing_hours=f"""{_AROUND}
select h as hour, {_HOUR} as date_hour from hours
where h not in (select date_trunc('hour', created_at) from raw)""",
    date_hour_to_path="""
, labels as (select distinct replace(source_file, '.json.gz', '') as l from raw),
variants as (
 select l as date_hour from labels
 union select l || '9' from labels
 union select replace(l, '-', '/') from labels
)
select date_hour, ok as is_valid, if(ok, 'events/' || date_hour || '.json.gz', null) as path
from (
 select date_hour,
  regexp_full_match(date_hour, '[0-9]{4}-[0-9]{2}-[0-9]{2}-[0-9]{1,2}')
  and cast(regexp_extract(date_hour, '[0-9]+$') as int) < 24 as ok
 from variants
)""",
    load_metrics=f"""
, lines as (
 select source_file, {LINE} as line, true as good from raw
 union all select 'trailing', {TRAILING}, false from raw
 union all select 'doubled', {LINE} || {LINE}, false from raw
 union all select 'documents', text, false from documents
 union all select 'props', props, false from events
)
select source_file, 'raw.github_events' as table_name, count(*) filter (where good) as rows_inserted,
 count(*) filter (where not good) as rows_failed, cast(sum(octet_length(encode(line)) + 1) as bigint) as bytes_processed
from lines group by source_file""",
    load_summary="""
, t as (
 select count(distinct source_file) as hours, count(*) as n, cast(sum(octet_length(encode(payload))) as bigint) as b
 from raw
)
select hours as hours_processed, cast(0 as bigint) as hours_failed, n as total_rows_inserted,
 (b // 10 + case when b % 10 > 5 or (b % 10 = 5 and (b // 10) % 2 = 1) then 1 else 0 end) / 100.0::double
  as total_size_mb,
 cast(n // hours + case when 2 * (n % hours) > hours or (2 * (n % hours) = hours and (n // hours) % 2 = 1)
                   then 1 else 0 end as bigint) as average_rows_per_hour,
 true as success
from t""",
    build_all_models="""
select 'staging.stg_github_events' as table_name, count(*) as row_count from stg
union all select 'staging.stg_actors', count(*) from stg_a
union all select 'staging.stg_repositories', count(*) from stg_r
union all select 'staging.stg_organizations', count(*) from stg_o
union all select 'marts.dim_actors', count(*) from dim_a
union all select 'marts.dim_repositories', count(*) from dim_r
union all select 'marts.dim_organizations', count(*) from dim_o
union all select 'marts.fct_github_events', count(*) from fact
union all select 'marts.agg_event_type_daily', count(*) from type_daily
union all select 'marts.agg_repository_daily', count(*) from repo_daily
union all select 'marts.agg_actor_daily', count(*) from actor_daily""",
)
