"""Staging models, star schema, daily aggregates, and the aggregation and ranking operators."""

from .base import TYPE_COUNTS, ratio, sql_map

SQL = sql_map(
    staging_events="select * from stg",
    stg_actors="select * from stg_a",
    stg_repositories="select * from stg_r",
    stg_organizations="select * from stg_o",
    dim_actors="select * from dim_a",
    dim_repositories="select * from dim_r",
    dim_organizations="select * from dim_o",
    fct_github_events="select * from fact",
    agg_event_type_daily="select * from type_daily",
    agg_repository_daily="select * from repo_daily",
    agg_actor_daily="select * from actor_daily",
    pivot_event_types=f"select event_date, {TYPE_COUNTS} from stg group by event_date",
    conditional_distinct="""
select event_hour, count(distinct repo_id) as repositories,
 count(distinct repo_id) filter (where event_type = 'PushEvent') as pushed_repositories,
 count(distinct repo_id) filter (where is_bot) as bot_repositories
from stg group by event_hour""",
    bool_any="""
select actor_id, bool_or(is_bot) as any_bot, not bool_and(is_public) as any_private
from stg group by actor_id""",
    group_by_expression="""
select ['night', 'morning', 'afternoon', 'evening'][event_hour // 6 + 1] as part_of_day, count(*) as events
from stg group by event_hour // 6""",
    distinct_counts_of_ranges="""
, spans(days) as (values (7), (30)),
seen as (select days, stg.* from stg join spans on event_date >= DATE '2024-01-31' - days),
parts as (
 select *, event_type as part from seen union all select *, cast(is_bot as varchar) from seen union all select *, 'all' from seen
)
select days, part, count(distinct actor_id) as unique_actors, count(distinct repo_id) as unique_repositories,
 count(distinct org_id) as unique_organizations
from parts group by days, part""",
    global_aggregate="""
select count(*) as events, min(created_at) as first_event, max(created_at) as last_event,
 count(distinct actor_id) as actors, count(distinct event_hour) as hours
from stg""",
    pct_of_total=f"""
, t as (select event_type, count(*) as events from stg group by event_type)
select event_type, events, {ratio("events", "(select count(*) from stg)", 100)} as percentage from t""",
    dedupe_rank="""
select actor_id, event_id, created_at from stg
qualify row_number() over (partition by actor_id order by created_at desc, event_id desc) = 1""",
    top_k="""
select actor_login, count(*) as events from stg group by actor_login
order by events desc, actor_login limit 10""",
    order_by_case="select event_type, count(*) as events from stg group by event_type",
    order_by_columns="select event_date, event_type, count(*) as events from stg group by all",
    latest_row="select source_file from raw order by created_at desc, source_file desc limit 1",
    head_sample_profile="""
select event_type, count(*) as events
from (select event_type from raw order by source_file, event_id limit 1000) group by event_type""",
)
