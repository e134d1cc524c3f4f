"""Distinct states, stored histories, stored failures, partitions with retention."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventmart.operators import checks, distinct_states
from eventmart.operators.upsert import upsert_raw
from eventmart.plans import pipeline, snapshots, staging
from eventmart.schemas import FLAT_COLUMNS
from eventmart.sources import lifecycle, tables
from eventmart.sources.tables import Warehouse, write_by_date

AS_OF = "2024-01-31"


# --- distinct states ------------------------------------------------------------------------------------


def test_numbers_are_dense_and_stay(spark, data, tmp_path, monkeypatch):
    monkeypatch.setattr(distinct_states, "_PER_TASK", 50)  # several slots
    path = str(tmp_path / "numbers")
    early = distinct_states.add_numbers(spark, data.events.filter("event_date < '2024-01-05'"), path).collect()
    first = {(r["kind"], r["entity_id"]): r["number"] for r in early}
    late = distinct_states.add_numbers(spark, data.events, path).collect()
    every = {(r["kind"], r["entity_id"]): r["number"] for r in late}
    assert len(late) == len(every) and first.items() <= every.items() and len(first) < len(every)
    for kind, column in distinct_states.KINDS.items():
        own = sorted(n for (k, _), n in every.items() if k == kind)
        assert own == list(range(1, data.events.select(column).dropna().distinct().count() + 1))


def test_more_entities_than_a_page(spark, tmp_path):
    many = spark.range(70_000).select(
        F.lit("2024-01-01").cast("date").alias("event_date"), F.lit("x").alias("event_type"), F.lit(False).alias("is_bot"),
        F.col("id").cast("string").alias("actor_id"), F.lit("one").alias("repo_id"), F.lit(None).cast("string").alias("org_id"),
    )
    days = many.unionByName(many.filter("actor_id < 40000").withColumn("event_date", F.lit("2024-01-02").cast("date")))
    bitmaps = distinct_states.daily_bitmaps(days, distinct_states.add_numbers(spark, days, str(tmp_path / "numbers")))
    assert tuple(distinct_states.distinct_counts(bitmaps).first()) == (70_000, 1, 0)
    per_day = distinct_states.distinct_counts(bitmaps, ["event_date"]).orderBy("event_date").collect()
    assert [r["unique_actors"] for r in per_day] == [70_000, 40_000]
    assert bitmaps.filter("kind = 'actor'").select("page").distinct().count() == 3
    assert distinct_states.distinct_counts(bitmaps.limit(0), ["event_type"]).collect() == []


def test_builds_keep_the_bitmaps_up_to_date(spark, data, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path))
    raw = warehouse.path(pipeline.RAW_TABLE)
    day = F.lit("2024-01-20").cast("date")
    emptied = data.raw.filter("event_date = '2024-01-22'").withColumn("event_type", F.lit("DeleteEvent"))
    loads = [data.raw.filter(F.col("event_date") > day), data.raw.filter(F.col("event_date") <= day).unionByName(emptied)]
    for step, load in enumerate(loads):
        upsert_raw(spark, raw, load.select(*FLAT_COLUMNS), "2024-01-30 23:00:00")
        pipeline.build_all(spark, warehouse, AS_OF, AS_OF, gate=False, bitmaps=step == 0, snapshots=True)
    found = distinct_states.distinct_counts(warehouse.read(pipeline.DAILY_BITMAPS), ["event_date", "event_type"])
    events = warehouse.read("staging.stg_github_events")
    expected = events.groupBy("event_date", "event_type").agg(
        *[F.countDistinct(distinct_states.KINDS[k]).alias(n) for k, n in distinct_states.MEASURES.items()]
    )
    assert rows(found) == rows(expected)
    history = snapshots.read_snapshot(spark, warehouse.path("snapshots.stg_actors"))
    current = warehouse.read("staging.stg_actors")
    assert rows(history.filter("is_open"), "actor_id") == rows(current, "actor_id")


def test_a_range_reads_only_its_days(spark, data, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    write_by_date(staging.activity_days(data.events), warehouse.path(pipeline.ACTIVITY))
    pipeline.build_bitmaps(warehouse)
    few = warehouse.read(pipeline.DAILY_BITMAPS).filter("event_date >= DATE '2024-01-29'")
    plan = distinct_states.distinct_counts(few)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "Join" not in plan


# --- snapshots ------------------------------------------------------------------------------------------


def _state(spark, *rows):
    return spark.createDataFrame([(k, v, dt.datetime(2024, 1, d)) for k, v, d in rows], "id string, v string, updated_at timestamp")


def _history(spark, path):
    found = snapshots.read_snapshot(spark, path).collect()
    return sorted((r["id"], r["v"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day, r["is_open"]) for r in found)


def test_stored_history(spark, tmp_path):
    path = str(tmp_path / "history")

    def merge(day, *rows, close=True):
        snapshots.store_snapshot(spark, path, _state(spark, *rows), "id", "updated_at", close, f"2024-01-{day:02d}")

    merge(2, ("a", "1", 1), ("b", "1", 1))
    closed_before = {f.name for f in (tmp_path / "history").glob("is_open=false/*.parquet")}
    assert closed_before == set()
    merge(6, ("a", "2", 5), ("c", "1", 5))
    expected = [("a", "1", 1, 5, False), ("a", "2", 5, None, True), ("b", "1", 1, 6, False), ("c", "1", 5, None, True)]
    assert _history(spark, path) == expected
    closed = {f.name for f in (tmp_path / "history").glob("is_open=false/*.parquet")}
    merge(7, ("a", "2", 5), ("c", "1", 5))
    assert _history(spark, path) == expected
    assert {f.name for f in (tmp_path / "history").glob("is_open=false/*.parquet")} == closed  # not written again
    merge(9, ("b", "3", 8), close=False)
    assert _history(spark, path) == sorted([*expected, ("b", "3", 8, None, True)])
    merge(10)
    assert not any(open_ for *_, open_ in _history(spark, path))


def test_merge_reads_no_closed_version(spark, tmp_path):
    path = str(tmp_path / "history")
    for day in (1, 5):
        snapshots.store_snapshot(spark, path, _state(spark, ("a", str(day), day)), "id", "updated_at")
    known = snapshots.read_snapshot(spark, path).filter(snapshots.OPEN)
    assert "PartitionFilters: [isnotnull(is_open" in known._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("step", ["_write_text", "finish_replacement"])
def test_a_broken_merge_leaves_the_old_or_the_new_history(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "history")
    snapshots.store_snapshot(spark, path, _state(spark, ("a", "1", 1)), "id", "updated_at")
    old, calls = _history(spark, path), []
    plain = getattr(tables, step)

    def breaks(*arguments):
        calls.append(step)
        if len(calls) == (1 if step == "_write_text" else 4):
            raise OSError("lost")
        return plain(*arguments)

    monkeypatch.setattr(tables, step, breaks)
    with pytest.raises(OSError):
        snapshots.store_snapshot(spark, path, _state(spark, ("a", "2", 5)), "id", "updated_at")
    monkeypatch.undo()
    new = [("a", "1", 1, 5, False), ("a", "2", 5, None, True)]
    assert _history(spark, path) == (old if step == "_write_text" else new)
    snapshots.store_snapshot(spark, path, _state(spark, ("a", "2", 5)), "id", "updated_at")
    assert _history(spark, path) == new


# --- stored failures ------------------------------------------------------------------------------------


def test_a_stopped_build_leaves_its_failing_rows(spark, make_raw, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    late = dt.datetime(2024, 1, 30, 20)
    raw = make_raw({"event_type": "NoSuchEvent", "created_at": late}, {"event_type": "Other", "repo_name": "x", "created_at": late}, {"created_at": late})
    write_by_date(raw, warehouse.path(pipeline.RAW_TABLE))
    with pytest.raises(checks.QualityGateError) as error:
        pipeline.build_all(spark, warehouse, AS_OF)
    rows = checks.stored_rows(spark, warehouse.path("test_results.staging_failures"))
    found = sorted((r["test"].rpartition(".")[2], r["id"]) for r in rows.select("test", F.get_json_object("row", "$.event_id").alias("id")).collect())
    assert found == [("accepted_values_event_type", "0"), ("accepted_values_event_type", "1"), ("length_repo_name", "1")]
    assert error.value.failures == {f"staging.stg_github_events.{t}": n for t, n in (("accepted_values_event_type", 2), ("length_repo_name", 1))}
    assert "payload" not in rows.first()["row"]
    summary = {r["test"]: r["failures"] for r in warehouse.read("test_results.staging_summary").collect()}
    assert len(summary) == len(checks.run_checks(pipeline.staging_tests(spark, warehouse, AS_OF)).collect())
    assert sum(summary.values()) == 3
    write_by_date(make_raw({"created_at": late}), warehouse.path(pipeline.RAW_TABLE))
    pipeline.build_all(spark, warehouse, AS_OF, mode="full")
    assert checks.stored_rows(spark, warehouse.path("test_results.staging_failures")).count() == 0


def test_counts_are_those_of_the_tests(spark, data, tmp_path):
    suite = checks.Suite(
        "t", data.raw, {"no_login": checks.is_missing("actor_login"), "private": ~F.col("is_public")}, {"unique_actor_id": ["actor_id"]}
    )
    checks.store_layer([suite], str(tmp_path / "rows"))
    stored = checks.stored_counts([suite], str(tmp_path / "rows"))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, checks.run_checks([suite]).collect()))


def test_testing_a_table_reads_no_payload(spark, data, tmp_path):
    write_by_date(data.events, str(tmp_path))
    suite = checks.Suite("t", tables.read_by_date(spark, str(tmp_path)), {"no_login": checks.is_missing("actor_login")})
    plan = checks.failing_rows([suite])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "payload" not in plan.partition("ReadSchema")[2]


# --- partitions -----------------------------------------------------------------------------------------


def test_unexpected_dates_and_retention_at_the_sink(spark, make_raw, tmp_path):
    path, columns = str(tmp_path / "routed"), "event_id string, event_date date"

    def load(as_of, *dates):
        rows = make_raw(*[{"created_at": dt.datetime.fromisoformat(d)} for d in dates]).select(F.col("event_date").cast("string").alias("event_id"), "event_date")
        return lifecycle.write_routed(rows, path, "2023-01-01", "2024-06-01", 30, as_of)

    def left():
        return sorted((r["event_id"], r["partition_name"]) for r in lifecycle.read_routed(spark, path, columns).collect())

    assert load("2024-01-10", "1970-01-01", "2023-06-01", "2024-01-09", "2031-01-01") == []
    kept = [("1970-01-01", "default"), ("2024-01-09", "2024_01"), ("2031-01-01", "default")]
    assert left() == kept
    nulls = make_raw({}).select(F.lit("none").alias("event_id"), F.lit(None).cast("date").alias("event_date"))
    assert lifecycle.write_routed(nulls, path, "2023-01-01", "2024-06-01", 30, "2024-01-10") == []
    assert load("2024-02-20", "2024-02-19") == [dt.date(2024, 1, 9)]
    assert left() == [("1970-01-01", "default"), ("2024-02-19", "2024_02"), ("2031-01-01", "default"), ("none", "default")]
    assert lifecycle.drop_expired(spark, path, None) == []
    one = lifecycle.read_routed(spark, path, columns).filter("partition_name = '2024_02'")
    assert "PartitionFilters: [isnotnull(partition_name" in one._jdf.queryExecution().executedPlan().toString()
    assert len(list((tmp_path / "routed/partition_name=default").iterdir())) == 1  # no folder per junk date


def test_large_partition_from_one_task_is_cut(spark, tmp_path, monkeypatch):
    """Rows of a broken clock in one map task: its output for one key cannot be split, so the key must be."""
    monkeypatch.setattr(lifecycle, "PIECE_ROWS", 100, raising=False)
    path, merging = str(tmp_path / "routed"), "spark.sql.adaptive.coalescePartitions.enabled"
    date = F.when(F.col("id") < 50, F.lit("2024-01-09")).when(F.col("id") < 1900, F.lit("1970-01-01")).cast("date")
    rows = spark.range(0, 2000, 1, 1).select(F.col("id").cast("string").alias("event_id"), date.alias("event_date"))
    before = spark.conf.get(merging)
    spark.conf.set(merging, "false")  # few rows as these would be put together again
    try:
        lifecycle.write_routed(rows, path, "2023-01-01", "2024-06-01", 30, "2024-01-10")
    finally:
        spark.conf.set(merging, before)
    found = lifecycle.read_routed(spark, path, "event_id string, event_date date")
    assert sorted(int(r[0]) for r in found.select("event_id").collect()) == list(range(2000))
    files = found.groupBy("partition_name", F.input_file_name()).count().collect()
    assert [r["count"] for r in files if r["partition_name"] == "2024_01"] == [50]
    assert max(r["count"] for r in files) < 1000


def test_builds_with_retention(spark, data, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    upsert_raw(spark, warehouse.path(pipeline.RAW_TABLE), data.raw.select(*FLAT_COLUMNS), "2024-01-30 23:00:00")
    pipeline.build_all(spark, warehouse, AS_OF, AS_OF, gate=False)
    pipeline.build_all(spark, warehouse, AS_OF, AS_OF, gate=False, keep_days=10)
    for name in (pipeline.RAW_TABLE, "staging.stg_github_events", "marts.fct_github_events", "marts.agg_actor_daily"):
        assert warehouse.read(name).agg(F.min("event_date")).first()[0] == dt.date(2024, 1, 21)
    kept = data.events.filter("event_date >= '2024-01-21'").select("actor_id").distinct().count()
    assert warehouse.read("marts.dim_actors").count() == kept
