"""Replacing files: what is there after a stop at any step, and which files an upsert touches."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventmart.operators.upsert import upsert_raw
from eventmart.schemas import FLAT_COLUMNS
from eventmart.sources import tables
from eventmart.sources.raw_events import scan_raw


class Stopped(Exception):
    pass


def _numbers(spark, start, stop):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int"))
    return spark.range(start, stop).select(F.col("id").alias("n"), day.alias("event_date"))


def _read(spark, path):
    return sorted(r["n"] for r in tables.read_by_date(spark, path).collect())


def _stop_at(monkeypatch, step):
    """Writers stop before the record, or in the middle of the switch after it."""
    if step == "before the record":
        monkeypatch.setattr(tables, "_write_text", lambda *a: (_ for _ in ()).throw(Stopped()))
    else:
        original = tables.finish_replacement
        calls = []

        def stopping(spark, path):
            calls.append(path)
            if len(calls) % 2 == 1:
                return original(spark, path)
            files, root = tables._files(spark, path)
            if step == "some files moved":
                path_of = spark._jvm.org.apache.hadoop.fs.Path
                [new] = [s.getPath() for s in files.listStatus(root) if s.getPath().getName().startswith("_new-") and s.isDirectory()]
                file = path_of(tables._data_files(files, new)[0])
                target = path_of(root, file.getParent().getName())
                files.mkdirs(target)
                files.rename(file, path_of(target, file.getName()))
            raise Stopped

        monkeypatch.setattr(tables, "finish_replacement", stopping)


@pytest.mark.parametrize("step", ["before the record", "after the record", "some files moved"])
@pytest.mark.parametrize("mode", ["overwrite", "replace_dates"])
def test_a_stopped_write_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, mode, step):
    path = str(tmp_path / "a table")
    tables.write_by_date(_numbers(spark, 0, 9), path)
    change = _numbers(spark, 100, 104).filter("event_date > '2024-01-01'")
    after = sorted(r["n"] for r in change.collect()) + ([0, 3, 6] if mode == "replace_dates" else [])
    _stop_at(monkeypatch, step)
    with pytest.raises(Stopped):
        tables.write_by_date(change, path, mode)
    monkeypatch.undo()
    assert _read(spark, path) == (list(range(9)) if step == "before the record" else sorted(after))
    tables.write_by_date(change, path, mode)
    assert _read(spark, path) == sorted(after)
    assert not [f for f in Path(path).iterdir() if f.name.startswith(("_new", "_replace"))]


def test_full_refresh_and_emptied_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in (_numbers(spark, 0, 5), _numbers(spark, 7, 9), _numbers(spark, 0, 0)):
        tables.write_table(rows, path)
        assert sorted(r["n"] for r in spark.read.parquet(path).collect()) == sorted(r["n"] for r in rows.collect())
    table = tables.read_by_date(spark, path)
    tables.write_table(table.union(_numbers(spark, 1, 3)), path)  # computed from what it replaces
    assert spark.read.parquet(path).count() == 2


def test_an_upsert_replaces_only_files_with_its_keys(spark, make_raw, tmp_path):
    path = str(tmp_path / "raw table")
    day = dt.datetime(2024, 1, 10, 8)
    for i in range(4):
        upsert_raw(spark, path, make_raw(*[{"event_id": f"{i}-{k}", "created_at": day} for k in range(3)]).select(*FLAT_COLUMNS).coalesce(1))
    before = {f.name for f in Path(path).rglob("*.parquet")}
    again = make_raw({"event_id": "2-1", "created_at": day, "event_type": "ForkEvent"}, {"event_id": "new", "created_at": day})
    held = scan_raw(spark, path).filter("event_id = '2-0'").select(F.col("_metadata.file_name")).first()[0]
    assert upsert_raw(spark, path, again.select(*FLAT_COLUMNS)) == 2
    now = {f.name for f in Path(path).rglob("*.parquet")}
    assert before - now == {held}
    rows = {r["event_id"]: r["event_type"] for r in scan_raw(spark, path).collect()}
    assert len(rows) == 13 == scan_raw(spark, path).count() and rows["2-1"] == "ForkEvent" and rows["2-0"] == "PushEvent"
