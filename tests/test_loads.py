"""Load planning and audit."""

import datetime as dt

import pytest

from eventmart.operators import loads


def hours(df):
    return [r["date_hour"] for r in df.orderBy("hour").collect()]


def test_backfill_is_inclusive_and_unpadded(spark):
    found = hours(loads.hours_to_process(loads.hour_range(spark, "2026-04-18-0", "2026-04-18-5")))
    assert found == [f"2026-04-18-{h}" for h in range(6)]
    padded = hours(loads.hours_to_process(loads.hour_range(spark, "2026-04-18-9", "2026-04-18-10"), True))
    assert padded == ["2026-04-18-09", "2026-04-18-10"]


def test_ranges_cross_midnight_and_may_be_empty(spark):
    assert hours(loads.hours_to_process(loads.hour_range(spark, "2024-02-28-23", "2024-02-29-0"))) == [
        "2024-02-28-23",
        "2024-02-29-0",
    ]
    assert hours(loads.hours_to_process(loads.hour_range(spark, "2024-02-29-1", "2024-02-29-0"))) == []


@pytest.mark.parametrize(
    "label, valid",
    [
        ("2026-03-13-10", True),
        ("2026-03-13-5", True),
        ("2026-03-13-05", True),
        ("2024-02-29-10", True),
        ("2023-02-29-10", False),
        ("2026-03-13", False),
        ("2026-03-13-25", False),
        ("2026-13-01-10", False),
        ("2026-03-32-10", False),
        ("not-a-date", False),
        ("2026/03/13/10", False),
        ("", False),
        (None, False),
    ],
)
def test_date_hours(spark, label, valid):
    df = spark.createDataFrame([(label,)], "date_hour string")
    row = loads.date_hour_to_path(df, root="store/").first()
    assert row["is_valid"] is valid
    assert row["path"] == (f"store/{label}.json.gz" if valid else None)


def loaded(make_raw, *files):
    stamps = [dt.datetime.strptime(f, "%Y-%m-%d-%H") for f in files]
    return make_raw(*[{"source_file": f"{f}.json.gz", "created_at": t} for f, t in zip(files, stamps, strict=True)])


def bounds(df):
    return [(str(r["start_hour"]), str(r["end_hour"])) for r in df.collect()]


def test_load_range(make_raw):
    raw = loaded(make_raw, "2026-04-18-9", "2026-04-18-10")
    assert loads.last_processed_hour(raw).first()["last_hour"] == dt.datetime(2026, 4, 18, 10)
    now = "2026-04-18 15:20:00"
    assert bounds(loads.load_range(raw, now)) == [("2026-04-18 11:00:00", "2026-04-18 13:00:00")]
    assert bounds(loads.load_range(raw, "2026-04-18 12:59:00")) == [], "already up to date"
    assert bounds(loads.load_range(raw.limit(0), now)) == [("2026-04-18 00:00:00", "2026-04-18 13:00:00")]
    explicit = loads.load_range(raw, now, " 2026-04-15-0", "2026-04-15-23")
    assert bounds(explicit) == [("2026-04-15 00:00:00", "2026-04-15 23:00:00")]
    assert bounds(loads.load_range(raw, now, "2026-04-15-0", "soon")) == bounds(loads.load_range(raw, now))


def test_gaps_are_found(spark, make_raw):
    raw = loaded(make_raw, "2026-04-18-1", "2026-04-18-4")
    gaps = loads.missing_hours(raw, loads.hour_range(spark, "2026-04-18-0", "2026-04-18-5"))
    assert hours(gaps) == ["2026-04-18-0", "2026-04-18-2", "2026-04-18-3", "2026-04-18-5"]


def test_load_summary(spark):
    results = spark.createDataFrame(
        [("a", 10, 1.25), ("b", 0, 2.0), ("c", 5, 0.125), ("d", None, None)],
        "date_hour string, rows_inserted long, file_size_mb double",
    )
    row = loads.load_summary(results).first()
    assert (row["hours_processed"], row["hours_failed"], row["success"]) == (2, 2, False)
    assert (row["total_rows_inserted"], row["average_rows_per_hour"]) == (15, 8)
    assert row["total_size_mb"] == 3.38
    empty = loads.load_summary(results.limit(0)).first()
    assert empty["success"] and empty["hours_processed"] == 0 and empty["average_rows_per_hour"] == 0
