"""Cards at the edges: empty facts, empty previous periods, hour fields, variants."""

import datetime as dt

from eventmart.plans import cards, marts


def test_empty_fact_gives_nulls_not_errors(data):
    empty = data.fact.limit(0)
    nulls = cards.null_analysis(empty, "2024-01-31").first()
    assert nulls["total_records"] == 0 and nulls["org_coverage_pct"] is None
    fresh = cards.data_freshness(empty, "2024-01-31").first()
    assert fresh["latest_event_date"] is None and fresh["hours_since_ingestion"] is None


def test_hour_field_is_not_total_hours(make_raw):
    fact = marts.Models(make_raw({"ingested_at": dt.datetime(2024, 1, 10, 8)})).fact
    row = cards.data_freshness(fact, "2024-01-12 12:30:00").first()
    assert (row["hours_since_ingestion"], row["total_hours"]) == (4, 52)


def test_trending_without_a_previous_week(data):
    found = cards.trending_repositories(
        data.repository_daily, data.dim_repositories, "2024-01-05", min_events=1, limit=5
    ).collect()
    assert len(found) == 5
    assert all(r["previous_week_events"] == 0 and r["growth_percentage"] is None for r in found)


def test_first_day_has_only_new_developers(data):
    first, *_ = cards.new_vs_returning(data.fact, "2024-01-31").collect()
    assert first["returning_developers"] == 0 and first["new_developers"] > 0


def test_a_bot_event_still_counts_as_first_seen(make_raw):
    raw = make_raw(
        {"actor_login": "x[bot]", "created_at": dt.datetime(2024, 1, 9)},
        {"actor_login": "x", "created_at": dt.datetime(2024, 1, 10)},
    )
    rows = cards.new_vs_returning(marts.Models(raw).fact, "2024-01-31").collect()
    assert [(r["event_date"].day, r["new_developers"], r["returning_developers"]) for r in rows] == [(10, 0, 1)]


def test_window_includes_both_ends(make_raw):
    raw = make_raw(*[{"event_id": str(d), "created_at": dt.datetime(2024, 1, d)} for d in range(1, 32)])
    assert cards.total_events(marts.Models(raw).fact, "2024-01-31", days=7).first()[0] == 8


def test_variants_drop_or_add_columns(data):
    assert cards.bot_vs_human_trend(data.event_type_daily, include_percentage=False).columns == [
        "event_date",
        "bot_events",
        "human_events",
    ]
    assert "issues" not in cards.top_repositories(data.repository_daily, include_issues=False).columns
    assert "day_name" not in cards.hourly_heatmap(data.fact, include_day_name=False).columns
    assert "last_seen_at" not in cards.top_organizations(data.dim_organizations, include_last_seen=False).columns
    assert "days_active" not in cards.event_type_coverage(data.fact, include_days_active=False).columns
    assert len(cards.event_type_distribution(data.event_type_daily, "2024-01-31", limit=3).collect()) == 3


def test_cards_default_to_today(data):
    assert cards.total_events(data.fact).first()[0] == 0


def test_weekday_card_with_reference_labels(data):
    rows = cards.activity_by_weekday(data.fact, "2024-01-31", label_mode="reference").collect()
    assert rows[0]["day_name"] == "Monday" and rows[6]["day_name"] is None


def test_card_with_all_bots(data):
    humans = cards.activity_by_hour(data.fact, "2024-01-31").agg({"events": "sum"}).first()[0]
    everyone = cards.activity_by_hour(data.fact, "2024-01-31", bots="all").agg({"events": "sum"}).first()[0]
    assert everyone > humans
