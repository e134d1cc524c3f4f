"""The ordered build, incremental modes, gates, and the file stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventmart.operators.checks import QualityGateError
from eventmart.operators.upsert import upsert_raw
from eventmart.plans import marts, pipeline
from eventmart.schemas import FLAT_COLUMNS
from eventmart.sources.event_files import event_lines, write_event_files
from eventmart.sources.raw_events import scan_raw
from eventmart.sources.tables import Warehouse, write_by_date
from eventmart.streaming.hourly import load_new_files

AS_OF = "2024-01-31"


def build(spark, warehouse, mode):
    return {
        r["table_name"]: r["row_count"]
        for r in pipeline.build_all(spark, warehouse, AS_OF, AS_OF, mode, gate=False).collect()
    }


def load(spark, warehouse, rows):
    upsert_raw(spark, warehouse.path(pipeline.RAW_TABLE), rows.select(*FLAT_COLUMNS), "2024-01-30 23:00:00")


def test_lookback_equals_rebuild_and_strict_does_not(spark, data, tmp_path, rows):
    cut = F.lit("2024-01-25 06:00:00").cast("timestamp")
    early, late = data.raw.filter(F.col("created_at") < cut), data.raw.filter(F.col("created_at") >= cut)
    tables = ["fct_github_events", *pipeline.DAILY]
    found = {}
    for mode in ("lookback", "strict"):
        warehouse = Warehouse(spark, str(tmp_path / mode))
        load(spark, warehouse, early)
        build(spark, warehouse, "full")
        load(spark, warehouse, late)
        counts = build(spark, warehouse, mode)
        found[mode] = {t: rows(warehouse.read(f"marts.{t}")) for t in tables}
        assert counts["staging.stg_github_events"] == data.events.count()
    warehouse = Warehouse(spark, str(tmp_path / "lookback"))
    build(spark, warehouse, "full")
    rebuilt = {t: rows(warehouse.read(f"marts.{t}")) for t in tables}
    assert found["lookback"] == rebuilt
    missing = data.events.filter((F.col("created_at") >= cut) & (F.col("event_date") == "2024-01-25")).count()
    assert missing > 0
    assert len(found["strict"]["fct_github_events"]) == len(rebuilt["fct_github_events"]) - missing


def test_touched_dates_are_built_again_however_old(spark, data, tmp_path, rows):
    day, old = F.lit("2024-01-20").cast("date"), F.lit("2024-01-05").cast("date")
    base = data.raw.filter(F.col("event_date") > day)
    late = data.raw.filter(F.col("event_date") == old)
    emptied = data.raw.filter(F.col("event_date") == "2024-01-22").withColumn("event_type", F.lit("DeleteEvent"))
    warehouse = Warehouse(spark, str(tmp_path))
    for step in (base, late.unionByName(emptied)):
        load(spark, warehouse, step)
        build(spark, warehouse, "touched")
        assert pipeline._to_build(spark, warehouse)[0] == []
    found = {"touched": {}, "full": {}}
    tables = ["staging.stg_github_events", "staging.stg_actors", "marts.fct_github_events"]
    tables += [f"marts.{t}" for t in pipeline.DAILY]
    for mode in found:
        if mode == "full":
            build(spark, warehouse, mode)
        found[mode] = {t: rows(warehouse.read(t)) for t in tables}
    assert found["touched"] == found["full"]
    dates = {str(r["event_date"]) for r in found["touched"]["staging.stg_github_events"]}
    assert "2024-01-05" in dates and "2024-01-22" not in dates


def test_an_event_without_repository_name_warns_but_builds(spark, tmp_path, make_raw):
    warehouse = Warehouse(spark, str(tmp_path))
    load(spark, warehouse, make_raw({}, {"repo_id": "99", "repo_name": None}))
    pipeline.build_all(spark, warehouse, "2024-01-11", "2024-01-11")
    summary = warehouse.read("test_results.references_summary")
    assert summary.filter("test like '%no_orphan_repo_id' and failures > 0").count() == 1


def test_models_without_rows_build(spark, tmp_path, make_raw):
    warehouse = Warehouse(spark, str(tmp_path / "no-repository"))
    load(spark, warehouse, make_raw({"repo_id": None, "repo_name": None}))
    for mode in ("touched", "full", "touched"):
        counts = build(spark, warehouse, mode)
        assert (counts["marts.agg_repository_daily"], counts["marts.agg_actor_daily"]) == (0, 1)
    warehouse = Warehouse(spark, str(tmp_path / "nothing"))
    write_by_date(make_raw({}).limit(0), warehouse.path(pipeline.RAW_TABLE))
    assert set(build(spark, warehouse, "touched").values()) == {0}
    load(spark, warehouse, make_raw({}))
    assert set(build(spark, warehouse, "touched").values()) == {0, 1}
    assert Warehouse(spark, warehouse.root).read("marts.agg_repository_daily").count() == 1


def test_an_interrupted_first_build_is_simply_run_again(spark, tmp_path, make_raw):
    warehouse = Warehouse(spark, str(tmp_path))
    load(spark, warehouse, make_raw({}, {"created_at": dt.datetime(2026, 5, 1, 10)}))
    (tmp_path / "staging/stg_github_events/_temporary").mkdir(parents=True)
    assert build(spark, warehouse, "touched")["staging.stg_github_events"] == 2


def test_shuffled_fact_path_gives_the_same_table(spark, data, tmp_path, rows, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    load(spark, warehouse, data.raw.filter("event_date < '2024-01-04'"))
    pipeline.build_staging(spark, warehouse)
    pipeline.build_fact(warehouse, AS_OF, "full")
    broadcast = rows(warehouse.read("marts.fct_github_events"))
    monkeypatch.setattr(marts, "BROADCAST_ROWS", -1)
    pipeline.build_fact(warehouse, AS_OF, "full")
    assert rows(warehouse.read("marts.fct_github_events")) == broadcast


def test_failing_staging_test_stops_before_the_marts(spark, make_raw, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    bad = make_raw({"event_type": "NoSuchEvent", "created_at": dt.datetime(2024, 1, 30, 20)})
    write_by_date(bad, warehouse.path(pipeline.RAW_TABLE))
    with pytest.raises(QualityGateError) as error:
        pipeline.build_all(spark, warehouse, "2024-01-31")
    assert error.value.failures == {"staging.stg_github_events.accepted_values_event_type": 1}
    assert not warehouse.exists("marts.fct_github_events")


def test_stale_source_stops_the_build(spark, make_raw, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    write_by_date(make_raw({}), warehouse.path(pipeline.RAW_TABLE))
    with pytest.raises(pipeline.StaleSourceError):
        pipeline.build_all(spark, warehouse, AS_OF)


def test_gated_build_and_registered_tables(spark, make_raw, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    write_by_date(make_raw({"created_at": dt.datetime(2024, 1, 30, 20)}), warehouse.path(pipeline.RAW_TABLE))
    built = pipeline.build_all(spark, warehouse, "2024-01-30 23:00:00", AS_OF)
    assert {r["row_count"] for r in built.collect()} == {0, 1}
    for table in ("marts.fct_github_events", "marts.dim_actors"):
        warehouse.register(table)
    query = "SELECT count(*) FROM marts.fct_github_events WHERE event_date >= DATE '2024-01-01'"
    assert spark.sql(query).first()[0] == 1
    assert spark.table("marts.dim_actors").count() == 1
    with pytest.raises(ValueError):
        warehouse.path("elsewhere.table")


def test_stream_loads_only_new_files(spark, data, tmp_path, rows):
    landing, raw, checkpoint = (str(tmp_path / n) for n in ("landing", "raw", "checkpoint"))
    day = lambda d: data.raw.filter(F.col("event_date") == d)

    def run():
        query = load_new_files(spark, landing, raw, checkpoint, max_files_per_batch=10)
        query.awaitTermination(120)
        assert query.exception() is None
        return len(query.recentProgress)

    write_event_files(day("2024-01-02"), f"{landing}/first")
    run()
    assert scan_raw(spark, raw).count() == day("2024-01-02").count()
    write_event_files(day("2024-01-03"), f"{landing}/second")
    run()
    both = day("2024-01-02").unionByName(day("2024-01-03"))
    assert rows(scan_raw(spark, raw), "event_id", "event_type") == rows(both, "event_id", "event_type")
    before = rows(scan_raw(spark, raw))
    run()
    assert rows(scan_raw(spark, raw)) == before


def test_lines_of_a_hot_file_are_not_lost(spark, data):
    lines = event_lines(data.raw.withColumn("source_file", F.lit("2024-01-01-0.json.gz")))
    assert lines.count() == data.raw.count()


def test_categories_come_from_a_csv_file(spark, data, tmp_path):
    warehouse, csv = Warehouse(spark, str(tmp_path / "warehouse")), tmp_path / "categories.csv"
    csv.write_text("event_type,category,description,is_code_change\nPushEvent,code,Pushes,true\nNewEvent,other,,false\n")
    load(spark, warehouse, data.raw)
    pipeline.build_staging(spark, warehouse, categories_csv=str(csv))
    found = warehouse.read("seeds.event_type_categories").orderBy("event_type").collect()
    assert [tuple(r) for r in found] == [("NewEvent", "other", None, False), ("PushEvent", "code", "Pushes", True)]
