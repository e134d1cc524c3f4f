"""Builds from the manifest of loads: which dates they read, and what breaks or overlaps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventmart.operators import upsert
from eventmart.operators.incremental import drop_expired_partitions
from eventmart.plans import pipeline, staging
from eventmart.schemas import FLAT_COLUMNS
from eventmart.sources.manifest import LoadManifest
from eventmart.sources.tables import Warehouse, write_by_date

AS_OF = "2024-01-31"
TABLES = [f"staging.{t}" for t in ("stg_github_events", "activity_days", *pipeline.STAGING)]
TABLES += [f"marts.{t}" for t in ("fct_github_events", *pipeline.DIMENSIONS, *pipeline.DAILY)]


def load(spark, warehouse, rows):
    return upsert.upsert_raw(spark, warehouse.path(pipeline.RAW_TABLE), rows.select(*FLAT_COLUMNS), "2024-01-30 23:00:00")


def build(spark, warehouse, mode="touched"):
    pipeline.build_all(spark, warehouse, AS_OF, AS_OF, mode, gate=False)


def manifest(spark, warehouse):
    return LoadManifest(spark, warehouse.path(pipeline.RAW_TABLE))


def touched(spark, warehouse):
    return sorted(str(d) for d in pipeline.noted_dates(warehouse, manifest(spark, warehouse).newest()))


def at(day, **values):
    return {"created_at": dt.datetime(2024, 1, day, 10), **values}


def test_three_loads_equal_a_full_build(spark, make_raw, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path))
    first = make_raw(*[at(20 + i % 5, event_id=f"a{i}", actor_id=str(i % 3), actor_login=f"dev{i % 4}", repo_id=str(i % 2), repo_name=f"o/r{i % 5}") for i in range(20)])
    late = make_raw(at(2, event_id="late", actor_id="0", actor_login="zed", repo_id="9", repo_name="o/nine", org_id="5", org_login="o"))
    emptied = make_raw(*[at(21, event_id=f"a{i}", event_type="DeleteEvent") for i in (1, 6, 11, 16)])
    for step, dates in ((first, None), (late, ["2024-01-02"]), (emptied, ["2024-01-21"])):
        load(spark, warehouse, step)
        if dates:
            assert touched(spark, warehouse) == dates
        build(spark, warehouse)
        assert touched(spark, warehouse) == []
        found = {t: rows(warehouse.read(t)) for t in TABLES}
        build(spark, warehouse, "full")
        assert found == {t: rows(warehouse.read(t)) for t in TABLES}
    assert "2024-01-21" not in {str(r["event_date"]) for r in found["staging.activity_days"]}
    names = {r["actor_id"]: r["actor_login"] for r in found["staging.stg_actors"]}
    assert names["0"] == "zed"


def test_a_build_reads_touched_dates_of_events_only(spark, make_raw, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    load(spark, warehouse, make_raw(*[at(1 + i, event_id=str(i)) for i in range(6)]))
    build(spark, warehouse)
    load(spark, warehouse, make_raw(at(3, event_id="new")))
    scans = []
    original = pipeline.scan_raw

    def watched(session, path):
        found = original(session, path)
        scans.append(found)
        return found

    written = []
    monkeypatch.setattr(pipeline, "scan_raw", watched)
    write = pipeline.write_by_date

    def seen(df, path, *a, **k):
        written.append((path.rpartition("/")[2], df._jdf.queryExecution().executedPlan().toString()))
        write(df, path, *a, **k)

    monkeypatch.setattr(pipeline, "write_by_date", seen)
    dates, _ = pipeline._to_build(spark, warehouse)
    assert scans == [] and [str(d) for d in dates] == ["2024-01-03"]
    build(spark, warehouse)
    plans = dict(written)
    # every scan of events behind a model of this build is cut to the touched date
    for name in ("stg_github_events", "activity_days"):
        filters = [line for line in plans[name].splitlines() if "PartitionFilters" in line]
        assert filters and all("event_date" in f and "2024-01-03" in f for f in filters)


def test_a_broken_load_is_built_with_the_next_one(spark, make_raw, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    load(spark, warehouse, make_raw(at(1, event_id="a"), at(2, event_id="b")))
    build(spark, warehouse)

    def broken(*a, **k):
        raise OSError("the disk is full")

    monkeypatch.setattr(upsert, "_write_batch", broken)
    with pytest.raises(OSError):
        load(spark, warehouse, make_raw(at(2, event_id="c")))
    monkeypatch.undo()
    assert touched(spark, warehouse) == ["2024-01-02"]
    assert manifest(spark, warehouse).loads().select("load").distinct().count() == 1
    load(spark, warehouse, make_raw(at(2, event_id="c")))
    build(spark, warehouse)
    assert warehouse.read("marts.fct_github_events").count() == 3


def test_a_load_during_a_build_belongs_to_the_next(spark, make_raw, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    load(spark, warehouse, make_raw(at(1, event_id="a")))
    build(spark, warehouse)
    notes, path = manifest(spark, warehouse), warehouse.path(pipeline.RAW_TABLE)
    noted = make_raw(at(4, event_id="d")).groupBy("source_file", "event_date").agg(F.count("*").alias("n_rows"))
    notes.note(noted, False)  # the load has begun, its rows are not there yet
    build(spark, warehouse)
    write_by_date(make_raw(at(4, event_id="d")), path, "append")
    notes.note(noted, True)
    assert touched(spark, warehouse) == ["2024-01-04"]
    build(spark, warehouse)
    assert warehouse.read("marts.fct_github_events").count() == 2


def test_dropped_dates_leave_the_models(spark, make_raw, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    load(spark, warehouse, make_raw(at(1, event_id="a", actor_id="old"), at(20, event_id="b")))
    build(spark, warehouse)
    gone = drop_expired_partitions(spark, warehouse.path(pipeline.RAW_TABLE), 15, dt.date(2024, 1, 31))
    assert [str(d) for d in gone] == ["2024-01-01"] == touched(spark, warehouse)
    build(spark, warehouse)
    assert {r["actor_id"] for r in warehouse.read("staging.stg_actors").collect()} == {"1"}


def test_freshness_comes_from_the_manifest(spark, make_raw, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    load(spark, warehouse, make_raw(at(1)))
    assert pipeline.load_freshness(spark, warehouse, "2024-01-30 23:30:00").first()["status"] == "pass"
    assert pipeline.load_freshness(spark, warehouse, "2024-01-31 08:00:00").first()["status"] == "error"


def test_entity_models_of_states_and_of_events(spark, data, rows):
    days = staging.activity_days(data.events)
    assert days.agg(F.sum("n_events")).first()[0] == data.events.count()
    for model in pipeline.STAGING:
        for policy in ("max", "latest"):
            build_model = getattr(staging, model)
            assert rows(build_model(days, policy)) == rows(build_model(data.events, policy))
