"""Derived columns, names, joins under skew, and the fact's two build paths."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventmart.functions import bucket, day_name, percent, ratio
from eventmart.operators import aggregates, filters, joins, ranking
from eventmart.plans import marts, staging
from eventmart.schemas import REPO_COUNT_BUCKETS
from eventmart.sources.raw_events import raw_from_events
from eventmart.sources.seeds import EVENT_CATEGORIES, event_categories


def one(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def totals(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "total_events long")


def test_activity_level_bounds(spark):
    levels = marts.with_activity_level(totals(spark, 99, 100, 999, 1000, 9999, 10000))
    assert [r[1] for r in levels.collect()] == ["low", "medium", "medium", "high", "high", "very_high"]


def test_popularity_tier_bounds(spark):
    tiers = marts.with_popularity_tier(totals(spark, 999, 1000, 9999, 10000, 99999, 100000))
    assert [r[1] for r in tiers.collect()] == ["low", "medium", "medium", "high", "high", "viral"]


def test_repo_count_bucket_bounds(spark):
    sizes = spark.createDataFrame([(v,) for v in (9, 10, 19, 20, 49, 50, 99, 100)], "n long")
    labels = [r[0] for r in sizes.select(bucket("n", REPO_COUNT_BUCKETS, "1-9")).collect()]
    assert labels == ["1-9", "10-19", "10-19", "20-49", "20-49", "50-99", "50-99", "100+"]


def test_ratio_is_exact(spark):
    df = spark.createDataFrame([(201, 200), (-201, 200), (1, 3), (5, 0), (10**12 + 1, 10**12)], "a long, b long")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [1.01, -1.01, 0.33, None, 1.0]
    assert [r[0] for r in df.select(percent("a", "b")).collect()][:3] == [100.5, -100.5, 33.33]


def test_bots(make_raw):
    logins = ["app[bot]", "Dependabot-x", "GitHub-Actions", "my-RENOVATE", "greenkeeperio", "robot", "b[o]t"]
    events = staging.staging_events(make_raw(*[{"actor_login": x} for x in logins]))
    assert [r["is_bot"] for r in events.collect()] == [True] * 5 + [False] * 2


def test_staging_filters(make_raw):
    raw = make_raw({}, {"actor_login": None}, {"event_type": "DeleteEvent"}, {"actor_id": None})
    assert staging.staging_events(raw).count() == 1
    assert staging.staging_events(raw, excluded=[]).count() == 2


def test_weekday_numbers_and_names(make_raw):
    week = make_raw(*[{"created_at": dt.datetime(2026, 3, 15 + i)} for i in range(7)])
    days = staging.staging_events(week).orderBy("event_date")
    assert [r["event_day_of_week"] for r in days.collect()] == [1, 2, 3, 4, 5, 6, 7]
    names = days.select(day_name("event_day_of_week"), day_name("event_day_of_week", "reference")).collect()
    assert [r[0] for r in names][:2] == ["Sunday", "Monday"] and names[6][0] == "Saturday"
    assert [r[1] for r in names][:2] == ["Monday", "Tuesday"] and names[6][1] is None
    with pytest.raises(ValueError):
        day_name("event_day_of_week", "other")


def test_name_policies(make_raw):
    events = staging.staging_events(
        make_raw(
            {"actor_login": "zed", "created_at": dt.datetime(2024, 1, 1)},
            {"actor_login": "amy", "created_at": dt.datetime(2024, 1, 2)},
        )
    )
    assert one(staging.stg_actors(events), "actor_login", "total_events") == [("zed", 2)]
    assert one(staging.stg_actors(events, "latest"), "actor_login") == [("amy",)]
    with pytest.raises(ValueError):
        staging.stg_actors(events, "first")


def test_slug_without_slash_is_empty(make_raw):
    repos = staging.stg_repositories(staging.staging_events(make_raw({"repo_name": "plain"})))
    assert one(repos, "repo_owner", "repo_slug") == [("plain", "")]


@pytest.mark.parametrize("hot_rows", [1, 5, 10**6])
def test_lookup_join_ignores_the_hot_limit(data, rows, hot_rows):
    """All keys hot, some hot, none hot: the same rows."""
    plain = data.events.join(data.repositories.select("repo_id", "repo_owner", "repo_slug"), "repo_id", "left")
    found = marts.fact_join_repositories(data.events, data.repositories, hot_rows)
    columns = ["event_id", "repo_id", "repo_owner", "repo_slug"]
    assert rows(found, *columns) == rows(plain, *columns)
    inner = joins.lookup_join(
        data.events, data.repositories, "repo_id", ["repo_owner"], "total_events", "event_id", "inner", hot_rows
    )
    assert inner.count() == data.events.filter("repo_id IS NOT NULL").count()


def test_lookup_join_spreads_null_keys(spark):
    rows = spark.range(1000).select(F.lit(None).cast("string").alias("k"), "id")
    lookup = spark.createDataFrame([("a", "x", 1)], "k string, v string, n long")
    joined = joins.lookup_join(rows, lookup, "k", ["v"], "n", "id").hint("merge")
    assert joined.count() == 1000 and joined.filter("v IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        joins.lookup_join(rows, lookup, "k", ["v"], "n", "id", "outer")


def renamed(make_raw):
    return staging.staging_events(
        make_raw(
            {"repo_id": "1", "repo_name": "own/old"},
            {"repo_id": "1", "repo_name": "own/young"},
            {"repo_id": "2", "repo_name": "own/two"},
            {"repo_id": "2", "repo_name": None},
            {"repo_id": None, "repo_name": "lost/name"},
            {"repo_id": "4", "repo_name": None},
        )
    )


def test_fact_from_own_names_equals_the_join(make_raw, data, rows):
    for events in (renamed(make_raw), data.events):
        repositories = staging.stg_repositories(events)
        corrections = marts.repository_corrections(events, repositories)
        own = marts.fct_from_own_names(events, corrections, "2024-01-31")
        assert rows(own) == rows(marts.fct_github_events(events, repositories, "2024-01-31"))


def test_only_renamed_repositories_need_correction(make_raw):
    events = renamed(make_raw)
    corrections = marts.repository_corrections(events, staging.stg_repositories(events))
    assert sorted(one(corrections, "repo_id", "repo_slug")) == [("1", "young"), ("2", "two")]


def test_conditional_distinct_matches_count_distinct(data, rows):
    bot = F.col("is_bot")
    found = aggregates.conditional_distinct(data.events, ["event_date"], "actor_id", {"n": None, "bots": bot})
    plain = data.events.groupBy("event_date").agg(
        F.count_distinct("actor_id").alias("n"), F.count_distinct(F.when(bot, F.col("actor_id"))).alias("bots")
    )
    assert rows(found) == rows(plain)


def test_conditional_distinct_keeps_groups_without_values(spark):
    df = spark.createDataFrame([("g", None), ("h", "x")], "k string, v string")
    found = aggregates.conditional_distinct(df, ["k"], "v", {"n": None})
    assert sorted(one(found, "k", "n")) == [("g", 0), ("h", 1)]


def test_daily_models_with_a_dominant_key(make_raw):
    """A third of the rows in one repository, one actor, one type."""
    events = [{"actor_id": "hot", "repo_id": "hot", "org_id": "o"}] * 40 + [
        {"actor_id": str(i), "repo_id": str(i % 7), "event_type": "ForkEvent"} for i in range(80)
    ]
    fact = data_fact(make_raw(*[e | {"event_id": str(i)} for i, e in enumerate(events)]))
    by_type = {r["event_type"]: r for r in marts.agg_event_type_daily(fact).collect()}
    assert by_type["PushEvent"]["total_events"] == 40 and by_type["PushEvent"]["unique_actors"] == 1
    assert by_type["ForkEvent"]["unique_repositories"] == 7 and by_type["ForkEvent"]["distinct_hours_active"] == 1
    assert {r["repo_id"]: r["total_events"] for r in marts.agg_repository_daily(fact).collect()}["hot"] == 40


def data_fact(raw):
    return marts.Models(raw).fact


def test_null_repository_has_no_daily_row(make_raw):
    fact = data_fact(make_raw({"repo_id": None, "repo_name": None}))
    assert marts.agg_repository_daily(fact).count() == 0
    assert one(marts.agg_event_type_daily(fact), "unique_repositories") == [(0,)]


def test_seed_table(spark, tmp_path):
    seeds = event_categories(spark)
    assert seeds.count() == len(EVENT_CATEGORIES) == 15
    seeds.coalesce(1).write.csv(str(tmp_path / "seed"), header=True)
    assert sorted(event_categories(spark, str(tmp_path / "seed")).collect()) == sorted(seeds.collect())


def test_unknown_type_has_no_category(spark):
    found = joins.event_category_lookup(
        spark.createDataFrame([("DiscussionEvent",)], "event_type string"), event_categories(spark)
    )
    assert one(found, "category") == [(None,)]


def test_orders_and_shares(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "k string, n long")
    assert one(ranking.order_by_case(df, "k", {"c": 1, "b": 2}), "k") == [("c",), ("b",), ("a",)]
    assert one(ranking.top_k(df, "n", 2, "k"), "k") == [("c",), ("a",)]
    assert sorted(one(ranking.pct_of_total(df, "n"), "k", "percentage")) == [("a", 25.0), ("b", 25.0), ("c", 50.0)]


def test_dashboard_filters(data):
    everything = filters.dashboard_filters(data.events)
    assert everything.count() == data.events.count()
    humans = filters.dashboard_filters(data.events, bots="none").count()
    bots = filters.dashboard_filters(data.events, bots="only").count()
    assert humans + bots == everything.count() and bots > 0
    name = data.repositories.first()["repo_name"]
    one_repo = filters.dashboard_filters(data.events, repo_name=name)
    assert {r[0] for r in one_repo.select("repo_name").distinct().collect()} == {name}
    with pytest.raises(ValueError):
        filters.dashboard_filters(data.events, bots="some")


def test_adapter_keeps_every_event(data):
    assert raw_from_events(data.table("events")).count() == data.table("events").count()
