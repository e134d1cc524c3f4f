"""Upsert, de-duplication, incremental builds, retention, snapshots."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventmart.operators import incremental, upsert
from eventmart.schemas import FLAT_COLUMNS
from eventmart.sources.raw_events import scan_raw
from eventmart.sources.tables import date_folders, write_by_date

RUN = "2024-02-01 00:00:00"


def flat(df):
    return df.select(*FLAT_COLUMNS)


def test_dedupe_order_is_fixed(make_raw, rows):
    copies = make_raw(
        {"event_id": "a", "source_file": "1", "payload": "x"},
        {"event_id": "a", "source_file": "2", "payload": "x"},
        {"event_id": "a", "source_file": "2", "payload": "y"},
        {"event_id": "b"},
    )
    kept = rows(upsert.dedupe_batch(copies), "event_id", "source_file", "payload")
    assert [(r["event_id"], r["payload"]) for r in kept] == [("a", "y"), ("b", "{}")]


def test_dedupe_limits_copies_before_the_shuffle(make_raw):
    plan = upsert.dedupe_batch(make_raw({}))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize(
    "columns, payload", [(upsert.UPDATE_COLUMNS, "new"), (upsert.UPDATE_COLUMNS_KEEP_PAYLOAD, "old")]
)
def test_merge_columns(make_raw, columns, payload):
    old = make_raw({"event_id": "a", "payload": "old", "event_type": "PushEvent"}, {"event_id": "untouched"})
    evening = dt.datetime(2024, 1, 10, 18)
    again = {"event_id": "a", "payload": "new", "event_type": "ForkEvent", "created_at": evening}
    new = make_raw(again, {"event_id": "b"})
    merged = {r["event_id"]: r for r in upsert.merge_batch(old, new, RUN, columns).collect()}
    assert merged.keys() == {"a", "b", "untouched"}
    a = merged["a"]
    assert (a["event_type"], a["payload"]) == ("ForkEvent", payload)
    assert a["created_at"].hour == 12, "the first creation time stays"
    assert a["ingested_at"].day == 10 and a["updated_at"].month == 2
    assert merged["b"]["ingested_at"] == merged["b"]["updated_at"]
    assert merged["untouched"]["updated_at"].month == 1


def test_upsert_twice_is_upsert_once(spark, data, tmp_path, rows):
    path = str(tmp_path / "raw")
    batch = flat(data.raw)
    assert upsert.upsert_raw(spark, path, batch, RUN) == 1000
    once = rows(scan_raw(spark, path))
    assert upsert.upsert_raw(spark, path, batch, RUN) == 1000
    assert rows(scan_raw(spark, path)) == once


def test_new_dates_are_appended_not_rewritten(spark, make_raw, tmp_path):
    path = str(tmp_path / "raw")
    upsert.upsert_raw(spark, path, flat(make_raw({"event_id": "a"})), RUN)
    day = tmp_path / "raw" / "event_date=2024-01-10"
    before = {f.name for f in day.glob("*.parquet")}
    upsert.upsert_raw(spark, path, flat(make_raw({"event_id": "b"})), RUN)
    assert before < {f.name for f in day.glob("*.parquet")}
    upsert.upsert_raw(spark, path, flat(make_raw({"event_id": "a"})), RUN)
    assert not before & {f.name for f in day.glob("*.parquet")}
    assert scan_raw(spark, path).count() == 2


def test_empty_batch(spark, make_raw, tmp_path):
    assert upsert.upsert_raw(spark, str(tmp_path / "raw"), flat(make_raw({}).limit(0))) == 0


def days(make_raw, *dates):
    return make_raw(*[{"event_id": str(i), "created_at": dt.datetime(2024, 1, d, 9)} for i, d in enumerate(dates)])


def test_strict_misses_late_rows_and_lookback_finds_them(make_raw):
    built = days(make_raw, 9, 10)
    source = days(make_raw, 3, 9, 10, 10, 11)
    found = lambda **kw: sorted(
        r[0].day for r in incremental.incremental_filter(source, built, **kw).select("event_date").collect()
    )
    assert found(mode="strict") == [11]
    assert found(mode="lookback", lookback_days=2) == [9, 10, 10, 11]
    empty = built.limit(0)
    late = incremental.incremental_filter(source, empty, floor="2024-01-09", mode="strict")
    assert late.count() == 3
    assert incremental.incremental_filter(source, dt.date(2024, 1, 10), mode="strict").count() == 1
    with pytest.raises(ValueError):
        found(mode="other")


def test_incremental_filter_prunes_folders(spark, data, tmp_path):
    path = str(tmp_path / "raw")
    write_by_date(data.raw, path)
    picked = incremental.incremental_filter(scan_raw(spark, path), dt.date(2024, 1, 29), mode="strict")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "> 2024-01-29" in plan


def test_merge_by_key(spark, rows):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    new = spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string")
    merged = incremental.merge_by_key(target, new, ["k"])
    assert [(r["k"], r["v"]) for r in rows(merged)] == [(1, "old"), (2, "new"), (3, "new")]


def test_retention(spark, make_raw, tmp_path):
    raw = days(make_raw, 1, 20, 30)
    assert incremental.expire_partitions(raw, None).count() == 3
    assert incremental.expire_partitions(raw, 11, "2024-01-31").count() == 2
    path = str(tmp_path / "raw")
    write_by_date(raw, path)
    assert incremental.drop_expired_partitions(spark, path, None) == []
    gone = incremental.drop_expired_partitions(spark, path, 11, dt.date(2024, 1, 31))
    assert gone == [dt.date(2024, 1, 1)]
    assert sorted(date_folders(spark, path)) == [dt.date(2024, 1, 20), dt.date(2024, 1, 30)]
    assert scan_raw(spark, path).count() == 2


def test_route_partitions(make_raw):
    routed = incremental.route_partitions(days(make_raw, 5), "2024-01-15", "2024-02-01")
    assert routed.first()["partition_name"] == "2024_01"
    routed = incremental.route_partitions(days(make_raw, 5), "2024-02-01", "2024-03-01")
    assert routed.first()["partition_name"] == "default"


def test_snapshot_history(spark):
    def state(*values):
        return spark.createDataFrame(
            [(k, v, dt.datetime(2024, 1, d)) for k, v, d in values], "id string, v string, updated_at timestamp"
        )

    first = incremental.snapshot_merge(None, state(("a", "1", 1), ("b", "1", 1)), "id", "updated_at")
    second = incremental.snapshot_merge(first, state(("a", "2", 5), ("c", "1", 5)), "id", "updated_at")
    third = incremental.snapshot_merge(second, state(("a", "2", 5), ("b", "1", 1)), "id", "updated_at")
    history = sorted(
        (r["id"], r["v"], r["valid_from"].day, r["valid_to"].day if r["valid_to"] else None) for r in third.collect()
    )
    assert history == [("a", "1", 1, 5), ("a", "2", 5, None), ("b", "1", 1, None), ("c", "1", 5, None)]


def test_write_modes(spark, make_raw, tmp_path):
    path = str(tmp_path / "t")
    write_by_date(days(make_raw, 1, 2), path)
    write_by_date(days(make_raw, 2, 2, 3), path, "replace_dates", ["event_type"])
    assert scan_raw(spark, path).groupBy("event_date").count().filter(F.col("count") == 2).count() == 1
    assert scan_raw(spark, path).count() == 4
    with pytest.raises(ValueError):
        write_by_date(days(make_raw, 1), path, "merge")
