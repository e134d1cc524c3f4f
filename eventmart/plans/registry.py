"""Every operator as a query over the whole generic ``events`` table (a few add other tables).

``QUERIES[key](spark, folder)`` reads ``<folder>/*.parquet``.  The clock is pinned to ``AS_OF``.
Sinks and upserts write below the session's shared folder and return a scan of what they wrote.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_of_timestamp, bucket, contributor_type, day_name, distinct_hours, is_bot, repo_owner, repo_slug, utc_date, utc_floor
from ..operators import aggregates, checks, distinct_states, filters, incremental, joins, loads, ranking, upsert
from ..schemas import (
    ACCEPTED_EVENT_TYPES,
    EVENTS,
    EXCLUDED_EVENT_TYPES,
    FLAT_COLUMNS,
    RAW_COLUMNS,
    REPO_COUNT_BUCKETS,
    REPOSITORY_TYPE_COLUMNS,
)
from ..sources import event_files, lifecycle, nested, tables
from ..sources.raw_events import raw_from_events, scan_raw
from ..sources.scratch import new_folder
from ..sources.seeds import event_categories
from . import cards, ingest, marts, pipeline, quality_suites, snapshots, staging

AS_OF = "2024-01-31"
RELOAD_AT = "2024-02-01 00:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Data(marts.Models):
    """The models over one test-data folder, plus its other tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        super().__init__(raw_from_events(self.table("events")), AS_OF)

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(EVENTS) if name == "events" else self.spark.read
        return reader.parquet(f"{self.folder}/{name}.parquet")

    def new_folder(self, label: str) -> str:
        return new_folder(self.spark, label)


def query(key: str):
    def register(build: Callable[[Data], DataFrame]):
        QUERIES[key] = lambda spark, folder: build(Data(spark, folder))
        return build

    return register


def _before(df: DataFrame, date: str) -> DataFrame:
    return df.filter(F.col("event_date") < F.lit(date).cast("date"))


def _from(df: DataFrame, date: str) -> DataFrame:
    return df.filter(F.col("event_date") >= F.lit(date).cast("date"))


def _unstamped(df: DataFrame) -> DataFrame:
    return df.drop(marts.BUILD_STAMP)


def _redelivered(raw: DataFrame) -> DataFrame:
    """The same events delivered again by later files, with a changed type and payload."""
    return raw.withColumns(
        {
            "event_type": F.lit("ReleaseEvent"),
            "payload": F.lit('{"v":2}'),
            "source_file": F.concat(F.lit("redelivered-"), F.col("source_file")),
        }
    ).select(*FLAT_COLUMNS)


def _all_lines(d: Data) -> DataFrame:
    """Event lines, the same with something after them (trailing, one of six things, and doubled), lines that are not
    JSON (documents) and JSON that is no event (props)."""
    events = event_files.event_lines(d.raw)
    after = [" trailing", ',"x":1', ',"__end":true', ']}', ',{"__end":""}']
    rest = F.array(*[F.lit(a) for a in after], F.concat(F.lit(',"__line":['), "value"))
    chosen = F.get(rest, F.length("value") % 6)
    trailing = events.select(F.concat("value", chosen).alias("value"), F.lit("trailing").alias("source_file"))
    doubled = events.select(F.concat("value", "value").alias("value"), F.lit("doubled").alias("source_file"))
    documents = d.table("documents").select(F.col("text").alias("value"), F.lit("documents").alias("source_file"))
    props = d.table("events").select(F.col("props").alias("value"), F.lit("props").alias("source_file"))
    return events.unionByName(trailing).unionByName(doubled).unionByName(documents).unionByName(props)


def _suppliers(d: Data) -> DataFrame:
    """Suppliers as known accounts; many events are by others."""
    return d.table("supplier").select(F.col("s_suppkey").cast("string").alias("account_id"))


# --- scans, sources, sinks ----------------------------------------------------------------------------


@query("scan_event_files")
def _(d):
    path = event_files.write_event_files(d.raw, d.new_folder("event-files"))
    lines = event_files.parse_lines(event_files.scan_event_files(d.spark, path))
    return lines.select(
        "source_file",
        "event.id",
        "event.type",
        F.col("event.actor.login").alias("actor_login"),
        F.col("event.repo.name").alias("repo_name"),
        F.col("event.public").alias("is_public"),
        "event.created_at",
    )


@query("reject_bad_lines")
def _(d):
    _, bad = event_files.reject_bad_lines(_all_lines(d))
    return bad.select("source_file", "reject_reason", F.md5("value").alias("line_md5"))


@query("flatten_events")
def _(d):
    good, _ = event_files.reject_bad_lines(_all_lines(d))
    return event_files.flatten_events(good)


@query("raw_sink")
def _(d):
    path = d.new_folder("raw")
    tables.write_by_date(d.raw, path, cluster_by=tables.CLUSTERING)
    return scan_raw(d.spark, path)


@query("scan_raw")
def _(d):
    return d.raw.select(*RAW_COLUMNS)


@query("seed_event_categories")
def _(d):
    path = d.new_folder("seeds")
    event_categories(d.spark).write.csv(path, header=True)
    used = d.raw.groupBy("event_type").agg(F.count("*").alias("events"))
    seeds = event_categories(d.spark, path).join(used, "event_type", "left")
    return seeds.withColumn("events", F.coalesce("events", F.lit(0)))


@query("table_sink")
def _(d):
    path = d.new_folder("dim-actors")
    tables.write_table(d.dim_actors, path)
    return _unstamped(d.spark.read.parquet(path))


@query("clustered_fact_sink")
def _(d):
    path = d.new_folder("fact")
    tables.write_clustered(d.fact, path)
    return _unstamped(d.spark.read.parquet(path))


@query("store_test_failures")
def _(d):
    suite = checks.Suite(
        "raw_events",
        d.raw,
        {
            "not_null_actor_login": checks.is_missing("actor_login"),
            "accepted_event_type": checks.not_accepted("event_type", _kept_types()),
        },
        {"unique_actor_id": ["actor_id"]},
    )
    root = d.new_folder("test-results")
    checks.store_failures([suite], root)
    counts = [
        checks.read_failures(suite, root, name)
        .agg(F.count("*").alias("failing_rows"))
        .withColumn("test", F.lit(f"raw_events.{name}"))
        for name in suite.names()
    ]
    return reduce(DataFrame.unionByName, counts)


@query("legacy_nested_scan")
def _(d):
    return nested.read_paths(nested.nested_events(d.raw))


@query("legacy_event_type_counts")
def _(d):
    return nested.count_by_type(nested.nested_events(d.raw))


# --- projections ----------------------------------------------------------------------------------------


@query("clean_projection")
def _(d):
    return staging.clean_projection(d.raw)


@query("bot_flag")
def _(d):
    return d.raw.select("event_id", "actor_login", is_bot().alias("is_bot"))


@query("time_dimensions")
def _(d):
    return staging.add_time_dimensions(d.raw.select("event_id", "created_at"))


@query("split_repo_name")
def _(d):
    return d.raw.select(
        "event_id",
        "repo_name",
        repo_owner("repo_name").alias("repo_owner"),
        repo_slug("repo_name").alias("repo_slug"),
    )


@query("activity_level")
def _(d):
    levels = [(85, "very_high"), (70, "high"), (55, "medium")]
    counted = d.actors.select("actor_id", "total_events")
    return marts.with_activity_level(counted, levels)


@query("popularity_tier")
def _(d):
    tiers = [(60, "viral"), (30, "high"), (15, "medium")]
    return marts.with_popularity_tier(d.repositories.select("repo_id", "total_events"), tiers)


@query("avg_events_per_day")
def _(d):
    return marts.with_avg_events_per_day(d.actors.select("actor_id", "total_events", "active_days"))


@query("contributor_diversity_pct")
def _(d):
    counted = d.repositories.select("repo_id", "unique_contributors", "total_events")
    return marts.with_contributor_diversity(counted)


@query("avg_events_per_repo")
def _(d):
    return marts.with_avg_events_per_repo(
        d.organizations.select("org_id", "total_events", "total_repositories")
    )


@query("repo_count_bucket")
def _(d):
    label = bucket("total_repositories", REPO_COUNT_BUCKETS, "1-9")
    return d.organizations.select("org_id", "total_repositories", label.alias("repo_count_bucket"))


@query("contributor_type")
def _(d):
    return d.raw.select("event_id", "org_id", contributor_type().alias("contributor_type"))


@query("day_name")
def _(d):
    return d.events.select(
        "event_id",
        "event_day_of_week",
        day_name("event_day_of_week").alias("day_name"),
        day_name("event_day_of_week", "reference").alias("reference_day_name"),
    )


@query("updated_at_stamp")
def _(d):
    return d.dim_organizations.select("org_id", marts.BUILD_STAMP)


# --- filters --------------------------------------------------------------------------------------------


def _kept_types() -> list[str]:
    return [t for t in ACCEPTED_EVENT_TYPES if t not in EXCLUDED_EVENT_TYPES]


def _rows(df: DataFrame) -> DataFrame:
    return df.select("event_id", "event_date", "event_type", "actor_login", "repo_id")


@query("quality_filter")
def _(d):
    return _rows(filters.quality_filter(d.raw))


@query("exclude_event_types")
def _(d):
    return _rows(filters.exclude_event_types(d.raw))


@query("entity_not_null")
def _(d):
    return _rows(filters.entity_not_null(d.raw, "repo_id", "repo_name"))


@query("incremental_filter")
def _(d):
    target = _before(d.events, "2024-01-20")
    return _rows(incremental.incremental_filter(d.events, target, mode="strict"))


@query("incremental_filter_lookback")
def _(d):
    target = _before(d.events, "2024-01-20")
    return _rows(incremental.incremental_filter(d.events, target, mode="lookback", lookback_days=7))


@query("trailing_days")
def _(d):
    return _rows(filters.trailing_days(d.raw, 7, AS_OF))


@query("between_windows")
def _(d):
    return _rows(filters.between_days(d.raw, 14, 7, AS_OF))


@query("event_type_in")
def _(d):
    return _rows(filters.event_type_in(d.raw, ["PushEvent", "ForkEvent"]))


@query("exclude_bots")
def _(d):
    return _rows(filters.exclude_bots(d.events))


@query("dashboard_filters")
def _(d):
    return _rows(
        filters.dashboard_filters(
            d.events, "2024-01-05", "2024-01-25", ["PushEvent", "WatchEvent"], bots="only"
        )
    )


# --- upsert, de-duplication, incremental, retention -----------------------------------------------------


@query("dedupe_batch")
def _(d):
    flat = d.raw.select(*FLAT_COLUMNS)
    return upsert.dedupe_batch(flat.unionByName(_redelivered(d.raw)).unionByName(flat))


@query("upsert_raw")
def _(d):
    path = d.new_folder("raw")
    tables.write_by_date(_before(d.raw, "2024-01-20"), path)
    batch = _from(_redelivered(d.raw), "2024-01-10")
    upsert.upsert_raw(d.spark, path, batch, RELOAD_AT)
    return scan_raw(d.spark, path)


@query("upsert_raw_keep_payload")
def _(d):
    batch = _from(_redelivered(d.raw), "2024-01-10")
    return upsert.merge_batch(
        _before(d.raw, "2024-01-20"), batch, RELOAD_AT, upsert.UPDATE_COLUMNS_KEEP_PAYLOAD
    )


@query("incremental_merge")
def _(d):
    first_load = d.fact.filter(F.col("created_at") < as_of_timestamp("2024-01-20 06:00:00"))
    target = _unstamped(marts.agg_event_type_daily(first_load))
    new = _unstamped(marts.agg_event_type_daily(_from(d.fact, "2024-01-15")))
    return incremental.merge_by_key(target, new, ["event_date", "event_type"])


@query("full_refresh")
def _(d):
    path = d.new_folder("dim-organizations")
    partial_state = staging.stg_organizations(_before(d.events, "2024-01-10"))
    tables.write_table(marts.dim_organizations(partial_state), path)
    tables.write_table(d.dim_organizations, path)
    return _unstamped(d.spark.read.parquet(path))


@query("route_partitions")
def _(d):
    orders = d.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("event_date"))
    return incremental.route_partitions(orders, "1995-01-01", "1996-12-01")


@query("expire_partitions")
def _(d):
    return _rows(incremental.expire_partitions(d.raw, 14, AS_OF))


@query("snapshot_scd2")
def _(d):
    def state(events):
        return staging.stg_actors(events).select(
            "actor_id", "actor_login", "total_events", F.col("last_seen_at").alias("updated_at")
        )

    first = incremental.snapshot_merge(None, state(_before(d.events, "2024-01-16")), "actor_id", "updated_at")
    return incremental.snapshot_merge(first, state(d.events), "actor_id", "updated_at")


@query("snapshot_builds")
def _(d):
    """A stored history after three builds, each of whose states lacks the entities of other days: activity of a
    repository by event type."""
    path = d.new_folder("snapshot")
    entity = F.concat_ws("/", F.coalesce("repo_id", F.lit("none")), "event_type")
    builds = [(None, "2024-01-13", "2024-01-13"), ("2024-01-08", "2024-01-21", "2024-01-21"), ("2024-01-16", None, AS_OF)]
    for first, end, built in builds:
        events = _from(d.events, first) if first else d.events
        events = _before(events, end) if end else events
        state = events.groupBy(entity.alias("entity")).agg(F.count("*").alias("n_events"), F.max("created_at").alias("updated_at"))
        snapshots.store_snapshot(d.spark, path, state, "entity", "updated_at", close_missing=True, as_of=built)
    return snapshots.read_snapshot(d.spark, path)


@query("partition_life_cycle")
def _(d):
    """Two loads into monthly partitions that keep 14 days, the first with the events of a broken clock as well."""
    path, columns = d.new_folder("routed"), ["event_id", "event_type", "created_at", "event_date"]
    epoch = F.timestamp_seconds(F.lit(0))
    broken = d.raw.withColumns({"created_at": epoch, "event_date": utc_date(epoch)})
    first = _before(d.raw, "2024-01-20").select(*columns).unionByName(broken.select(*columns))
    for load, as_of in ((first, "2024-01-20"), (_from(d.raw, "2024-01-15").select(*columns), AS_OF)):
        lifecycle.write_routed(load, path, "2023-07-01", "2024-06-01", 14, as_of)
    schema = "event_id string, event_type string, created_at timestamp, event_date date"
    return lifecycle.read_routed(d.spark, path, schema)


# --- joins ----------------------------------------------------------------------------------------------


@query("fact_join_repositories")
def _(d):
    return d.fact.select("event_id", "repo_id", "repo_owner", "repo_slug")


def _weeks(d: Data) -> DataFrame:
    date, today = F.col("event_date"), F.lit(AS_OF).cast("date")
    current = date >= F.date_sub(today, 7)
    previous = (date >= F.date_sub(today, 14)) & (date < F.date_sub(today, 7))
    return joins.compare_periods(d.repository_daily, "repo_id", "total_events", current, previous)


@query("join_previous_period")
def _(d):
    return _weeks(d).withColumn("previous_events", F.coalesce("previous_events", F.lit(0)))


@query("join_dimension")
def _(d):
    named = joins.join_dimension(_weeks(d), d.dim_repositories, "repo_id", ["repo_name"])
    return named.select("repo_id", "repo_name", "current_events")


@query("join_first_activity")
def _(d):
    return joins.join_first_seen(d.events.select("actor_id", "event_date").distinct(), "actor_id")


@query("anti_join_orphans")
def _(d):
    return _rows(joins.anti_join_orphans(d.raw, "actor_id", _suppliers(d), "account_id", "event_id"))


@query("merge_match")
def _(d):
    return upsert.merge_match(_before(d.raw, "2024-01-20"), _from(_redelivered(d.raw), "2024-01-10"))


@query("event_category_lookup")
def _(d):
    found = joins.event_category_lookup(d.raw.select("event_id", "event_type"), event_categories(d.spark))
    return found.select("event_id", "event_type", "category", "is_code_change")


# --- models and aggregations ----------------------------------------------------------------------------


@query("stg_actors")
def _(d):
    return d.actors


@query("stg_repositories")
def _(d):
    return d.repositories


@query("stg_organizations")
def _(d):
    return d.organizations


@query("dim_actors")
def _(d):
    return _unstamped(d.dim_actors)


@query("dim_repositories")
def _(d):
    return _unstamped(d.dim_repositories)


@query("dim_organizations")
def _(d):
    return _unstamped(d.dim_organizations)


@query("fct_github_events")
def _(d):
    return _unstamped(d.fact)


@query("agg_event_type_daily")
def _(d):
    return _unstamped(d.event_type_daily)


@query("agg_repository_daily")
def _(d):
    return _unstamped(d.repository_daily)


@query("agg_actor_daily")
def _(d):
    return _unstamped(d.actor_daily)


@query("pivot_event_types")
def _(d):
    return d.events.groupBy("event_date").agg(*aggregates.pivot_event_types(REPOSITORY_TYPE_COLUMNS))


@query("conditional_distinct")
def _(d):
    return aggregates.conditional_distinct(
        d.events,
        ["event_hour"],
        "repo_id",
        {
            "repositories": None,
            "pushed_repositories": F.col("event_type") == "PushEvent",
            "bot_repositories": F.col("is_bot"),
        },
    )


@query("bool_any")
def _(d):
    return d.events.groupBy("actor_id").agg(
        F.bool_or("is_bot").alias("any_bot"), F.bool_or(~F.col("is_public")).alias("any_private")
    )


@query("distinct_counts_of_ranges")
def _(d):
    """Distinct entities of the last 7 and 30 days by event type and by kind of account, and over all, from the bitmaps
    of two loads, the second of which brings some days again."""
    warehouse = tables.Warehouse(d.spark, d.new_folder("warehouse"))
    for rows in (_before(d.events, "2024-01-16"), _from(d.events, "2024-01-11")):
        tables.write_by_date(staging.activity_days(rows), warehouse.path(pipeline.ACTIVITY), "replace_dates")
        dates = [r[0] for r in warehouse.read(pipeline.ACTIVITY).select("event_date").distinct().collect()]
        pipeline.build_bitmaps(warehouse, "touched", dates=dates)
    parts = []
    for days in (7, 30):
        bitmaps = filters.trailing_days(warehouse.read(pipeline.DAILY_BITMAPS), days, AS_OF)
        for by in ("event_type", "is_bot", None):
            counts = distinct_states.distinct_counts(bitmaps, [by] if by else [])
            value = F.col(by).cast("string") if by else F.lit("all")
            parts.append(counts.select(F.lit(days).alias("days"), value.alias("part"), *distinct_states.MEASURES.values()))
    return reduce(DataFrame.unionByName, parts)


@query("group_by_expression")
def _(d):
    part_of_day = bucket("event_hour", [(18, "evening"), (12, "afternoon"), (6, "morning")], "night")
    return aggregates.group_by_expression(
        d.events, part_of_day, "part_of_day", [F.count("*").alias("events")], order=F.min("event_hour")
    )


@query("global_aggregate")
def _(d):
    return d.events.agg(
        F.count("*").alias("events"),
        F.min("created_at").alias("first_event"),
        F.max("created_at").alias("last_event"),
        F.count_distinct("actor_id").alias("actors"),
        distinct_hours().alias("hours"),
    )


@query("staging_events")
def _(d):
    return d.events


# --- windows, sorts, top-k ------------------------------------------------------------------------------


@query("pct_of_total")
def _(d):
    grouped = d.events.groupBy("event_type").agg(F.count("*").alias("events"))
    return ranking.pct_of_total(grouped, "events")


@query("dedupe_rank")
def _(d):
    newest = [F.desc("created_at"), F.desc("event_id")]
    return ranking.first_per_key(d.events.select("actor_id", "event_id", "created_at"), ["actor_id"], newest)


@query("top_k")
def _(d):
    grouped = d.events.groupBy("actor_login").agg(F.count("*").alias("events"))
    return ranking.top_k(grouped, "events", 10, "actor_login")


@query("order_by_case")
def _(d):
    grouped = d.events.groupBy("event_type").agg(F.count("*").alias("events"))
    return ranking.order_by_case(grouped, "event_type", ["PushEvent", "PullRequestEvent", "IssuesEvent"])


@query("order_by_columns")
def _(d):
    grouped = d.events.groupBy("event_date", "event_type").agg(F.count("*").alias("events"))
    return grouped.orderBy("event_date", "event_type")


@query("latest_row")
def _(d):
    return ranking.latest_row(d.raw)


@query("head_sample_profile")
def _(d):
    return ranking.head_sample_profile(event_files.event_lines(d.raw), 1_000, ["source_file", "value"])


# --- dashboard cards ------------------------------------------------------------------------------------

CARDS = {
    "total_events_30d": ("fact", cards.total_events),
    "active_developers_7d": ("fact", cards.active_developers),
    "active_repos_7d": ("fact", cards.active_repos),
    "daily_event_trend_90d": ("fact", cards.daily_event_trend),
    "event_type_distribution_30d": ("event_type_daily", cards.event_type_distribution),
    "bot_vs_human_trend_30d": ("event_type_daily", cards.bot_vs_human_trend),
    "active_users_trend_90d": ("fact", cards.active_users_trend),
    "public_vs_private_30d": ("event_type_daily", cards.public_vs_private),
    "hourly_heatmap_30d": ("fact", cards.hourly_heatmap),
    "top_repositories_7d": ("repository_daily", cards.top_repositories),
    "repository_growth_90d": ("fact", cards.repository_growth),
    "activity_breakdown_30d": ("repository_daily", cards.activity_breakdown),
    "top_developers_7d": ("actor_daily", cards.top_developers),
    "daily_active_developers_90d": ("fact", cards.daily_active_developers),
    "activity_by_hour_7d": ("fact", cards.activity_by_hour),
    "activity_by_weekday_30d": ("fact", cards.activity_by_weekday),
    "top_organizations": ("dim_organizations", cards.top_organizations),
    "org_vs_individual_30d": ("fact", cards.org_vs_individual),
    "org_activity_trend_90d": ("fact", cards.org_activity_trend),
    "event_type_trend_30d": ("event_type_daily", cards.event_type_trend),
    "event_type_engagement_30d": ("event_type_daily", cards.event_type_engagement),
    "hourly_by_event_type_7d": ("fact", cards.hourly_by_event_type),
    "data_freshness": ("fact", cards.data_freshness),
    "daily_record_counts_30d": ("fact", cards.daily_record_counts),
    "null_analysis_7d": ("fact", cards.null_analysis),
    "event_type_counts_7d": ("fact", cards.event_type_counts),
    "daily_trend_with_developers_90d": ("fact", cards.daily_trend_with_developers),
    "push_events_7d": ("fact", partial(cards.events_of_type, event_type="PushEvent")),
}
TIMELESS_CARDS = {
    "total_organizations": ("dim_organizations", cards.total_organizations),
    "popularity_distribution": ("dim_repositories", cards.popularity_distribution),
    "top_repo_owners": ("dim_repositories", cards.top_repo_owners),
    "activity_level_distribution": ("dim_actors", cards.activity_level_distribution),
    "orgs_by_repo_count": ("dim_organizations", cards.orgs_by_repo_count),
    "event_type_coverage": ("fact", cards.event_type_coverage),
    "latest_date_and_types": ("raw", cards.latest_date_and_types),
    "raw_row_count": ("raw", cards.raw_row_count),
}
for _key, (_mart, _card) in CARDS.items():
    query(_key)(lambda d, mart=_mart, card=_card: card(getattr(d, mart), as_of=AS_OF))
for _key, (_mart, _card) in TIMELESS_CARDS.items():
    query(_key)(lambda d, mart=_mart, card=_card: card(getattr(d, mart)))


@query("new_vs_returning_30d")
def _(d):
    first_seen = d.events.groupBy("actor_id").agg(F.min("created_at").alias("first_seen_at"))
    return cards.new_vs_returning(d.fact, AS_OF, actors=first_seen)


@query("trending_repositories")
def _(d):
    return cards.trending_repositories(d.repository_daily, d.dim_repositories, AS_OF)


# --- data quality ---------------------------------------------------------------------------------------


@query("test_not_null")
def _(d):
    return _rows(checks.check_not_null(d.raw, "actor_login"))


@query("test_unique")
def _(d):
    return checks.check_unique(d.raw, "actor_id")


@query("test_unique_combination")
def _(d):
    return checks.check_unique(d.raw, "event_date", "actor_id")


@query("test_accepted_values")
def _(d):
    return _rows(checks.check_accepted_values(d.raw, "event_type", _kept_types()))


@query("test_not_empty_string")
def _(d):
    owners = d.raw.select("event_id", repo_slug("org_login").alias("org_slug"))
    return checks.check_not_empty_string(owners, "org_slug")


@query("test_column_type")
def _(d):
    return checks.check_column_type(d.raw, "created_at", "date")


@query("test_between")
def _(d):
    hours = d.events.select("event_id", "event_hour")
    return checks.check_between(hours, "event_hour", 6, 18)


@query("test_length_between")
def _(d):
    names = d.raw.select("event_id", "repo_name")
    return checks.check_length_between(names, "repo_name", 3, 13, "repo_name IS NOT NULL")


@query("test_no_future_events")
def _(d):
    return checks.check_no_future_events(d.raw, "2024-01-25")


@query("test_positive_counts")
def _(d):
    counts = ["total_events", "unique_repositories"]
    return checks.check_positive_counts(d.actor_daily, counts, ["event_date", "actor_id", "total_events"])


@query("test_event_date_matches")
def _(d):
    return checks.check_event_date_matches(d.raw, "ingested_at")


@query("test_no_orphans")
def _(d):
    return checks.check_no_orphans(d.raw, "actor_id", _suppliers(d), "account_id")


@query("test_recency")
def _(d):
    return checks.check_recency(d.raw, "created_at", 7, "2024-02-15")


@query("source_freshness")
def _(d):
    return checks.source_freshness(d.raw, as_of="2024-01-31 05:30:00")


@query("check_constraints")
def _(d):
    damaged = d.raw.withColumns(
        {
            "event_date": utc_date("ingested_at"),
            "event_type": F.when(F.col("event_type") != "DeleteEvent", F.col("event_type")).otherwise(""),
        }
    )
    return checks.check_constraints(damaged)


@query("quality_gate")
def _(d):
    suites = quality_suites.staging_suites(d.events, d.actors, d.repositories, d.organizations, "2024-01-25")
    return checks.run_checks([quality_suites.source_suite(d.raw), *suites])


@query("stored_failures")
def _(d):
    """What a gated build leaves that its tests stop: the failing rows of each test."""
    warehouse = tables.Warehouse(d.spark, d.new_folder("warehouse"))
    tables.write_by_date(d.raw, warehouse.path(pipeline.RAW_TABLE))
    try:
        pipeline.build_all(d.spark, warehouse, "2024-01-25", AS_OF, mode="full")
    except checks.QualityGateError as stopped:
        failing = sorted(stopped.failures)
    rows = checks.stored_rows(d.spark, warehouse.path("test_results.staging_failures"))
    event = F.from_json("row", "event_id string, created_at timestamp, event_date date, is_bot boolean")
    stopping = F.col("test").isin(failing).alias("stops_the_build")
    return rows.select("test", event.alias("event"), stopping).select("test", "event.*", "stops_the_build")


# --- load planning and audit ----------------------------------------------------------------------------


def _data_hours(d: Data) -> DataFrame:
    hour = utc_floor("created_at", 3_600)
    return d.raw.agg(F.min(hour).alias("start_hour"), F.max(hour).alias("end_hour"))


@query("hours_to_process")
def _(d):
    return loads.hours_to_process(_data_hours(d))


@query("last_processed_hour")
def _(d):
    return loads.last_processed_hour(d.raw)


@query("load_range")
def _(d):
    return loads.load_range(d.raw, "2024-02-01 06:30:00")


@query("missing_hours")
def _(d):
    day = F.expr("INTERVAL 24 HOURS")  # the days around the data are gaps
    around = _data_hours(d).select((F.col("start_hour") - day).alias("start_hour"), (F.col("end_hour") + day).alias("end_hour"))
    return loads.missing_hours(d.raw, around)


@query("date_hour_to_path")
def _(d):
    label = F.replace(F.col("source_file"), F.lit(loads.EXTENSION), F.lit(""))
    variants = F.array(label, F.concat(label, F.lit("9")), F.replace(label, F.lit("-"), F.lit("/")))
    labels = d.raw.select("source_file").distinct().select(F.explode(variants).alias("date_hour"))
    return loads.date_hour_to_path(labels.distinct(), root="events/")


@query("load_metrics")
def _(d):
    return loads.load_metrics(_all_lines(d))


@query("load_summary")
def _(d):
    per_file = d.raw.groupBy("source_file").agg(
        F.count("*").alias("rows_inserted"),
        (F.sum(F.octet_length("payload")).cast("decimal(20,0)") * F.lit("0.001").cast("decimal(4,3)")).alias(
            "file_size_mb"
        ),
    )
    return loads.load_summary(per_file)


@query("build_all_models")
def _(d):
    warehouse = tables.Warehouse(d.spark, d.new_folder("warehouse"))
    tables.write_by_date(d.raw, warehouse.path(pipeline.RAW_TABLE))
    return pipeline.build_all(d.spark, warehouse, AS_OF, AS_OF, mode="full", gate=False)


@query("incremental_build")
def _(d):
    """Three loads, a build of the touched dates after each: the newer dates, the older ones, and an update that
    leaves a date without kept events."""
    warehouse = tables.Warehouse(d.spark, d.new_folder("warehouse"))
    emptied = d.raw.filter(F.col("event_date") == F.lit("2024-01-22").cast("date")).withColumn("event_type", F.lit("DeleteEvent"))
    for load in (_from(d.raw, "2024-01-11"), _before(d.raw, "2024-01-11"), emptied):
        upsert.upsert_raw(d.spark, warehouse.path(pipeline.RAW_TABLE), load.select(*FLAT_COLUMNS), AS_OF)
        pipeline.build_all(d.spark, warehouse, AS_OF, AS_OF, gate=False)
    none = lambda kind: F.lit(None).cast(kind)
    wanted = {
        "staging.stg_actors": ("actor_id", "actor_login", "unique_repositories", "unique_event_types"),
        "staging.stg_repositories": ("repo_id", "repo_name", "unique_contributors", "unique_event_types"),
        "staging.stg_organizations": ("org_id", "org_login", "total_repositories", "unique_contributors"),
        "marts.agg_event_type_daily": ("event_type", None, "unique_actors", "unique_repositories"),
        "marts.agg_repository_daily": ("repo_id", "repo_name", "unique_contributors", "unique_event_types"),
        "marts.agg_actor_daily": ("actor_id", "actor_login", "unique_repositories", "unique_event_types"),
    }
    parts = []
    for name, (key, title, first, second) in wanted.items():
        daily = name.startswith("marts")
        seen = ["first_seen_at", "last_seen_at"]
        parts.append(
            warehouse.read(name).select(
                F.lit(name).alias("model"),
                F.col("event_date") if daily else none("date").alias("event_date"),
                F.col(key).alias("entity_id"),
                F.col(title).alias("entity_name") if title else none("string").alias("entity_name"),
                "total_events",
                F.col(first).alias("distinct_1"),
                F.col(second).alias("distinct_2"),
                none("long").alias("active_days") if daily else F.col("active_days"),
                *[none("timestamp").alias(c) if daily else F.col(c) for c in seen],
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _audited_load(d: Data) -> DataFrame:
    """Outcome per file of loading the events' files and one more that is no gzip file (the nations as plain text)."""
    landing = event_files.write_event_files(d.raw, d.new_folder("event-files"))
    broken = f"{landing}/source_file=2024-02-01-0.json.gz"
    d.table("nation").select(F.col("n_name").alias("value")).coalesce(1).write.text(f"{broken}-draft")
    jvm = d.spark._jvm.org.apache.hadoop.fs
    files, [part] = jvm.Path(broken).getFileSystem(d.spark._jsc.hadoopConfiguration()), [
        r[0] for r in d.spark.read.text(f"{broken}-draft").select("_metadata.file_path").distinct().collect()
    ]
    files.mkdirs(jvm.Path(broken))
    files.rename(jvm.Path(d.spark._jvm.java.net.URI(part)), jvm.Path(f"{broken}/part-0.json.gz"))
    tables.delete_folder(d.spark, f"{broken}-draft")
    audit = d.new_folder("audit")
    ingest.ingest_files(d.spark, landing, d.new_folder("raw"), AS_OF, audit_path=audit)
    return ingest.read_audit(d.spark, audit)


@query("load_audit")
def _(d):
    columns = ["source_file", "table_name", "rows_inserted", "rows_failed", "bytes_processed", "success", "loaded_at"]
    return _audited_load(d).select(*columns, F.col("error").isNotNull().alias("has_error"))
