"""Each data test passes on good rows and returns the bad ones."""

import datetime as dt

import pytest

from eventmart.operators import checks, joins
from eventmart.plans import marts, quality_suites


def frame(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


@pytest.mark.parametrize(
    "check, kind, good, bad",
    [
        (lambda d: checks.check_not_null(d, "c"), "string", ["a", ""], [None]),
        (lambda d: checks.check_accepted_values(d, "c", ["a", "b"]), "string", ["a", None], ["z"]),
        (lambda d: checks.check_accepted_values(d, "c", [True, False]), "boolean", [True, False, None], []),
        (lambda d: checks.check_not_empty_string(d, "c"), "string", ["a", None], ["", "  "]),
        (lambda d: checks.check_between(d, "c", 1, 7), "int", [1, 7, None], [0, 8]),
        (lambda d: checks.check_between(d, "c", low=1), "int", [1, 10**6], [0]),
        (lambda d: checks.check_between(d, "c", high=7), "int", [-5, 7], [8]),
        (lambda d: checks.check_length_between(d, "c", 3, 5, "c <> 'skip-me'"), "string", ["abc", "skip-me"], ["ab"]),
    ],
)
def test_row_tests(spark, check, kind, good, bad):
    failing = [r["c"] for r in check(frame(spark, good + bad, kind)).collect()]
    assert sorted(map(str, failing)) == sorted(map(str, bad))


def test_unique(spark):
    assert checks.check_unique(frame(spark, ["a", "b", None, None]), "c").count() == 0
    assert checks.check_unique(frame(spark, ["a", "a", "a"]), "c").collect() == [("a", 3)]


def test_column_type(spark):
    assert checks.check_column_type(frame(spark, [1], "int"), "c", "int").count() == 0
    assert checks.check_column_type(frame(spark, [1], "int"), "c", "date").first()["actual_type"] == "int"


def test_future_and_date_rules(make_raw):
    good, bad = make_raw({}), make_raw({"event_date": dt.date(2024, 1, 11)})
    assert checks.check_no_future_events(good, "2024-01-10 12:00:00").count() == 0
    assert checks.check_no_future_events(bad, "2024-01-10 12:00:00").count() == 1
    assert checks.check_no_future_events(good, "2024-01-10 11:59:59").count() == 1
    assert checks.check_event_date_matches(good).count() == 0
    assert checks.check_event_date_matches(bad).first()["created_date"] == dt.date(2024, 1, 10)


def test_positive_counts(make_raw):
    daily = lambda raw: marts.agg_event_type_daily(marts.Models(raw).fact)
    assert checks.check_positive_counts(daily(make_raw({}))).count() == 0
    assert checks.check_positive_counts(daily(make_raw({"repo_id": None}))).count() == 1


def test_orphans_follow_not_in(spark):
    child = spark.createDataFrame([("a", 1), ("x", 2), ("x", 3), (None, 4)], "k string, id int")
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    assert checks.check_no_orphans(child, "k", parent, "k").collect() == [("x", 2)]
    with_null = parent.union(spark.createDataFrame([(None,)], "k string"))
    assert checks.check_no_orphans(child, "k", with_null, "k").count() == 0
    child.createOrReplaceTempView("child"), with_null.createOrReplaceTempView("parent")
    assert spark.sql("SELECT * FROM child WHERE k NOT IN (SELECT k FROM parent)").count() == 0
    for hot_rows in (1, 100):
        rows = joins.anti_join_orphans(child, "k", parent, "k", "id", hot_rows)
        assert sorted(r["id"] for r in rows.collect()) == [2, 3]


def test_orphans_do_not_broadcast_the_parent(data):
    plan = joins.orphan_values(data.events, "repo_id", data.repositories, "repo_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_recency(make_raw):
    raw = make_raw({})
    assert checks.check_recency(raw, "created_at", 7, "2024-01-17").count() == 0
    assert checks.check_recency(raw, "created_at", 7, "2024-01-18").first()["days_since_latest"] == 8


@pytest.mark.parametrize("hours, status", [(1, "pass"), (4, "warn"), (7, "error")])
def test_freshness(make_raw, hours, status):
    loaded = dt.datetime(2024, 1, 10, 12)
    raw = make_raw({"ingested_at": loaded})
    now = str(loaded + dt.timedelta(hours=hours))
    assert checks.source_freshness(raw, as_of=now).first()["status"] == status


def test_freshness_of_nothing(make_raw):
    assert checks.source_freshness(make_raw({}).limit(0)).first()["status"] == "error"


def test_constraints(make_raw):
    raw = make_raw({}, {"event_type": "", "source_file": ""}, {"event_date": dt.date(2024, 1, 1)})
    rules = sorted((r["event_id"], r["rule"]) for r in checks.check_constraints(raw).collect())
    assert rules == [
        ("1", "event_type_not_empty"),
        ("1", "source_file_not_empty"),
        ("2", "event_date_matches_created_at"),
    ]


def test_gate(spark, tmp_path):
    good = checks.Suite("t", frame(spark, ["a", "b"]), {"not_null_c": checks.is_missing("c")}, {"unique_c": ["c"]})
    checks.quality_gate(checks.run_checks([good]))
    bad = checks.Suite("u", frame(spark, ["a", "a", None]), {"not_null_c": checks.is_missing("c")}, {"unique_c": ["c"]})
    with pytest.raises(checks.QualityGateError) as error:
        checks.quality_gate(checks.run_checks([good, bad]))
    assert error.value.failures == {"u.not_null_c": 1, "u.unique_c": 1}
    checks.store_failures([good, bad], str(tmp_path))
    stored = lambda suite, name: checks.read_failures(suite, str(tmp_path), name).collect()
    assert stored(good, "not_null_c") == [] and stored(good, "unique_c") == []
    assert stored(bad, "not_null_c") == [(None,)] and stored(bad, "unique_c") == [("a", 2)]


def test_row_tests_of_a_table_share_one_scan(data):
    suite, *_ = quality_suites.staging_suites(
        data.events, data.actors, data.repositories, data.organizations, "2024-01-31"
    )
    only_rows = checks.Suite(suite.table, suite.df, suite.rows)
    plan = checks.run_checks([only_rows])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and len(suite.rows) == 22


def test_combinations_with_a_null_part_count(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, None), ("b", 1)], "x string, y int")
    assert [tuple(r) for r in checks.check_unique(df, "x", "y").collect()] == [("a", None, 2)]
    assert checks.check_unique(df, "y").count() == 0
