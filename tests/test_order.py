"""Queries whose order is part of the result: rows come in the order that is stated here."""

import pytest
from tests.conftest import SMALL

from eventmart.plans.registry import QUERIES

_FIRST = ["PushEvent", "PullRequestEvent", "IssuesEvent"]
_PARTS = ["evening", "afternoon", "morning", "night"]
_SIZES = ["100+", "50-99", "20-49", "10-19", "1-9"]

#: Query -> sort key of a row.
ORDERS = {
    "top_k": lambda r: (-r["events"], r["actor_login"]),
    "order_by_case": lambda r: (_FIRST.index(r["event_type"]) if r["event_type"] in _FIRST else 3, r["event_type"]),
    "order_by_columns": lambda r: (r["event_date"], r["event_type"]),
    "group_by_expression": lambda r: _PARTS.index(r["part_of_day"]),
    "orgs_by_repo_count": lambda r: _SIZES.index(r["repo_count_bucket"]),
    "daily_event_trend_90d": lambda r: r["event_date"],
    "bot_vs_human_trend_30d": lambda r: r["event_date"],
    "active_users_trend_90d": lambda r: r["event_date"],
    "repository_growth_90d": lambda r: r["event_date"],
    "daily_active_developers_90d": lambda r: r["event_date"],
    "activity_by_hour_7d": lambda r: r["event_hour"],
    "activity_by_weekday_30d": lambda r: r["event_day_of_week"],
    "new_vs_returning_30d": lambda r: r["event_date"],
    "event_type_trend_30d": lambda r: (r["event_date"], r["event_type"]),
    "event_type_engagement_30d": lambda r: (-r["total_events"], r["event_type"]),
    "hourly_by_event_type_7d": lambda r: (r["event_hour"], r["event_type"]),
    "event_type_coverage": lambda r: (-r["record_count"], r["event_type"]),
    "event_type_counts_7d": lambda r: (-r["event_count"], r["event_type"]),
}


@pytest.mark.parametrize("key", ORDERS)
def test_rows_come_in_order(spark, key):
    found = [r.asDict() for r in QUERIES[key](spark, SMALL).collect()]
    assert found and found == sorted(found, key=ORDERS[key])
