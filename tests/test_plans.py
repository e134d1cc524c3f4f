"""The physical plans the package promises."""

import pytest

from eventmart.operators import loads
from eventmart.plans import cards, marts, staging
from eventmart.plans.registry import CARDS, QUERIES
from eventmart.sources.raw_events import scan_raw
from eventmart.sources.tables import write_by_date, write_clustered
from tests.conftest import SMALL

WRITING = {
    "scan_event_files",
    "raw_sink",
    "table_sink",
    "clustered_fact_sink",
    "store_test_failures",
    "upsert_raw",
    "full_refresh",
    "build_all_models",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES.keys() - WRITING))
def test_no_cross_join_and_no_python(spark, key):
    text = plan(QUERIES[key](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas"):
        assert operator not in text


@pytest.mark.parametrize("key", [k for k, (mart, _) in CARDS.items() if mart == "fact"])
def test_fact_cards_do_not_pay_for_the_lookup(spark, key):
    assert "Join" not in plan(QUERIES[key](spark, SMALL))


def test_staging_is_row_wise(data):
    assert "Exchange" not in plan(staging.staging_events(data.raw))


def test_date_filter_reaches_the_scan(data):
    assert "GreaterThanOrEqual(ts,2024-01-24" in plan(cards.total_events(data.fact, "2024-01-31", 7))


def test_cards_prune_date_folders_and_columns(spark, data, tmp_path):
    path = str(tmp_path / "fact")
    write_clustered(data.fact, path)
    text = plan(cards.events_of_type(spark.read.parquet(path), "PushEvent", "2024-01-31"))
    assert "PartitionFilters: [isnotnull(event_date" in text and ">= 2024-01-24" in text
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,PushEvent)]" in text
    assert "ReadSchema: struct<event_type:string>" in text


def test_fact_from_own_names_moves_no_event(spark, data, tmp_path):
    path = str(tmp_path / "events")
    write_by_date(data.events, path)
    events = spark.read.parquet(path)
    corrections = marts.repository_corrections(data.events, data.repositories)
    fact = marts.fct_from_own_names(events, corrections)
    joined = fact._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in joined and "SortMergeJoin" not in joined.split("Broadcast")[0]


def test_unread_distinct_counts_are_not_computed(data):
    assert "Expand" not in plan(cards.event_type_distribution(data.event_type_daily, "2024-01-31"))


def test_distinct_hours_need_no_expand(data):
    from eventmart.functions import distinct_hours

    grouped = data.events.groupBy("event_type").agg(distinct_hours().alias("h"))
    assert "Expand" not in plan(grouped)


def test_merge_keys_read_no_payload(spark, data, tmp_path):
    from eventmart.operators.upsert import merge_match

    path = str(tmp_path / "raw")
    write_by_date(data.raw, path)
    stored = scan_raw(spark, path)
    assert "payload" not in plan(merge_match(stored, stored))


def test_new_vs_returning_reads_its_window_only(spark, data, tmp_path):
    path = str(tmp_path / "fact")
    write_clustered(data.fact, path)
    own = cards.new_vs_returning(spark.read.parquet(path), "2024-01-31", 7, data.dim_actors)
    assert "PartitionFilters: [isnotnull(event_date" in plan(own)
    assert own.collect() == cards.new_vs_returning(data.fact, "2024-01-31", 7).collect()


def test_load_planning_prunes_dates(spark, data, tmp_path):
    path = str(tmp_path / "raw")
    write_by_date(data.raw, path)
    raw, newest = scan_raw(spark, path), loads.newest_rows(spark, path)
    assert loads.last_processed_hour(newest).collect() == loads.last_processed_hour(raw).collect()
    assert "PartitionFilters: [isnotnull(event_date" in plan(loads.last_processed_hour(newest))
    assert loads.load_range(newest, "2024-02-01 06:30:00").collect() == loads.load_range(raw, "2024-02-01 06:30:00").collect()
    explicit = loads.load_range(raw, "2024-02-01", "2024-01-03-0", "2024-01-04-5")
    assert "FileScan" not in plan(explicit) and explicit.count() == 1
    gaps = loads.missing_hours(raw, loads.hour_range(spark, "2024-01-03-0", "2024-01-04-5"))
    assert "PartitionFilters: [isnotnull(event_date" in plan(gaps) and ">= 2024-01-02" in plan(gaps)
    loads_of_path = spark.createDataFrame([], raw.schema)
    write_by_date(loads_of_path, str(tmp_path / "none"))
    assert loads.newest_rows(spark, str(tmp_path / "none")).isEmpty()
