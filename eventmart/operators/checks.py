"""Data tests.  Each ``check_*`` returns the failing rows; no rows means the test passes.

``run_checks`` evaluates all row-level tests of a table in one scan and returns failure counts only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_of_date, as_of_timestamp, utc_date
from ..functions.calendar import AsOf
from ..schemas import RAW_REQUIRED
from ..sources.tables import finish_replacement, replace_files
from .joins import orphan_values

# --- failing-row predicates -------------------------------------------------------------------


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, values: Sequence) -> Column:
    """Non-null and outside the list."""
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def is_blank(column: str) -> Column:
    return F.coalesce(F.trim(F.col(column)) == "", F.lit(False))


def outside(column: str | Column, low=None, high=None) -> Column:
    """Below ``low`` or above ``high``; an open end or a NULL value passes."""
    value = F.col(column) if isinstance(column, str) else column
    failing = F.lit(False)
    if low is not None:
        failing = failing | (value < low)
    if high is not None:
        failing = failing | (value > high)
    return F.coalesce(failing, F.lit(False))


def in_future(as_of: AsOf = None) -> Column:
    late = (F.col("created_at") > as_of_timestamp(as_of)) | (F.col("event_date") > as_of_date(as_of))
    return F.coalesce(late, F.lit(False))


def date_differs(timestamp: str = "created_at", date: str = "event_date") -> Column:
    return F.coalesce(F.col(date) != utc_date(timestamp), F.lit(False))


# --- tests ------------------------------------------------------------------------------------


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_missing(column))


def check_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Duplicated values (or value combinations) and how often they occur.

    NULLs of a single column pass; in a combination a NULL is a value like any other.
    """
    known = df.dropna(subset=list(columns)) if len(columns) == 1 else df
    counted = known.groupBy(*columns).agg(F.count("*").alias("n_records"))
    return counted.filter(F.col("n_records") > 1)


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(not_accepted(column, values))


def check_not_empty_string(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_blank(column))


def check_column_type(df: DataFrame, column: str, expected: str) -> DataFrame:
    """One row if the declared type differs, with the number of rows affected."""
    actual = df.schema[column].dataType.simpleString()
    return (
        df.agg(F.count("*").alias("rows_affected"))
        .select(
            F.lit(column).alias("column_name"),
            F.lit(expected).alias("expected_type"),
            F.lit(actual).alias("actual_type"),
            "rows_affected",
        )
        .filter(F.col("actual_type") != F.col("expected_type"))
    )


def check_between(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    return df.filter(outside(column, low, high))


def check_length_between(
    df: DataFrame, column: str, low: int, high: int, where: Column | str | None = None
) -> DataFrame:
    selected = df if where is None else df.filter(where)
    return selected.filter(outside(F.length(F.col(column)), low, high))


def check_no_future_events(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    return df.filter(in_future(as_of)).select("event_id", "created_at", "event_date")


def check_positive_counts(
    daily: DataFrame,
    counts: Sequence[str] = ("total_events", "unique_actors", "unique_repositories"),
    shown: Sequence[str] = ("event_date", "event_type", "total_events"),
) -> DataFrame:
    """Rows with a non-positive count; also fires when every repository id is NULL."""
    failing = reduce(lambda a, b: a | b, [F.col(c) <= 0 for c in counts])
    return daily.filter(failing).select(*shown)


def check_event_date_matches(df: DataFrame, timestamp: str = "created_at") -> DataFrame:
    return df.filter(date_differs(timestamp)).select(
        "event_id",
        "event_date",
        F.col(timestamp).alias("created_at"),
        utc_date(timestamp).alias("created_date"),
    )


def check_no_orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign-key values without a parent, one row per value with its row count."""
    return orphan_values(df, column, parent, parent_column)


def check_recency(df: DataFrame, timestamp: str, days_back: int = 7, as_of: AsOf = None) -> DataFrame:
    """One row if the newest value is more than ``days_back`` days old."""
    newest = df.agg(F.max(timestamp).alias("latest_timestamp"))
    age = F.datediff(as_of_date(as_of), utc_date("latest_timestamp"))
    return newest.withColumn("days_since_latest", age).filter(F.col("days_since_latest") > days_back)


def source_freshness(
    df: DataFrame,
    loaded_at: str = "ingested_at",
    warn_hours: float = 3,
    error_hours: float = 6,
    as_of: AsOf = None,
) -> DataFrame:
    """One verdict row: (max_loaded_at, age_seconds, status) with status pass, warn or error.

    A table without rows is an error.
    """
    age = F.unix_timestamp(as_of_timestamp(as_of)) - F.unix_timestamp("max_loaded_at")
    return (
        df.agg(F.max(loaded_at).alias("max_loaded_at"))
        .withColumn("age_seconds", age)
        .withColumn(
            "status",
            F.when(F.col("age_seconds") <= warn_hours * 3600, "pass")
            .when(F.col("age_seconds") <= error_hours * 3600, "warn")
            .otherwise("error"),
        )
    )


def check_constraints(raw: DataFrame) -> DataFrame:
    """Raw rows breaking a table constraint, one row per broken rule, in a single scan."""
    rules = {f"{c}_not_null": is_missing(c) for c in RAW_REQUIRED}
    rules["event_type_not_empty"] = F.coalesce(F.col("event_type") == "", F.lit(False))
    rules["source_file_not_empty"] = F.coalesce(F.col("source_file") == "", F.lit(False))
    rules["event_date_matches_created_at"] = date_differs()
    broken = F.array_compact(F.array(*[F.when(failing, rule) for rule, failing in rules.items()]))
    return raw.select("event_id", "event_date", F.explode(broken).alias("rule"))


# --- suites -----------------------------------------------------------------------------------


@dataclass
class Suite:
    """The tests of one table: predicates over its rows, unique keys, and free-standing tests."""

    table: str
    df: DataFrame
    rows: dict[str, Column] = field(default_factory=dict)
    unique: dict[str, Sequence[str]] = field(default_factory=dict)
    other: dict[str, DataFrame] = field(default_factory=dict)

    def single(self) -> dict[str, DataFrame]:
        """The failing rows of the tests that need a plan of their own."""
        return {name: check_unique(self.df, *cols) for name, cols in self.unique.items()} | self.other

    def names(self) -> list[str]:
        return [*self.rows, *self.unique, *self.other]


def run_checks(suites: Sequence[Suite]) -> DataFrame:
    """(test, failures) for every test: one scan per table plus one aggregate per unique key."""
    parts = []
    for suite in suites:
        if suite.rows:
            counted = suite.df.agg(*[F.count_if(p).alias(n) for n, p in suite.rows.items()])
            pairs = [
                F.struct(F.lit(f"{suite.table}.{n}").alias("test"), F.col(n).alias("failures"))
                for n in suite.rows
            ]
            parts.append(counted.select(F.inline(F.array(*pairs))))
        for name, failing in suite.single().items():
            parts.append(
                failing.agg(F.count("*").alias("failures")).select(
                    F.lit(f"{suite.table}.{name}").alias("test"), "failures"
                )
            )
    return reduce(DataFrame.unionByName, parts)


#: Columns that stored failing rows go without, so that testing a table does not read them.
LEFT_OUT = ("payload",)
_FAILURES = "row string, test string"
_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timeZone": "UTC"}


def failing_rows(suites: Sequence[Suite], left_out: Sequence[str] = LEFT_OUT) -> DataFrame:
    """``row`` (JSON) and ``test`` for every failing row of every test, one scan per table for its row-level tests; a row
    that fails several is there for each."""

    def as_json(columns):
        return F.to_json(F.struct(*columns), _JSON).alias("row")

    parts = []
    for suite in suites:
        if suite.rows:
            failed = F.array_compact(F.array(*[F.when(p, f"{suite.table}.{n}") for n, p in suite.rows.items()]))
            failing = suite.df.filter(reduce(lambda a, b: a | b, suite.rows.values()))
            shown = [c for c in suite.df.columns if c not in left_out]
            parts.append(failing.select(as_json(shown), F.explode(failed).alias("test")))
        for name, failing in suite.single().items():
            parts.append(failing.select(as_json(failing.columns), F.lit(f"{suite.table}.{name}").alias("test")))
    return reduce(DataFrame.unionByName, parts)


def store_layer(suites: Sequence[Suite], path: str) -> None:
    """Run all tests of a layer once: the table of failing rows at ``path``, a folder per failing test, is what their
    counts come from."""
    replace_files(failing_rows(suites), path, None, partition="test")


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """The failing rows that ``store_layer`` left; a filter on ``test`` prunes folders."""
    finish_replacement(spark, path)
    return spark.read.schema(_FAILURES).parquet(path)


def stored_counts(suites: Sequence[Suite], path: str) -> DataFrame:
    """(test, failures) for every test, 0 included, from the stored rows."""
    spark = suites[0].df.sparkSession
    names = spark.createDataFrame([(f"{s.table}.{n}",) for s in suites for n in s.names()], "test string")
    counted = stored_rows(spark, path).groupBy("test").agg(F.count("*").alias("failures"))
    return names.join(counted, "test", "left").select("test", F.coalesce("failures", F.lit(0)).alias("failures"))


class QualityGateError(RuntimeError):
    """Raised when a gated layer has failing tests."""

    def __init__(self, failures: Mapping[str, int]):
        super().__init__(f"failing tests: {dict(failures)}")
        self.failures = dict(failures)


def quality_gate(summary: DataFrame) -> None:
    """Stop the build if any test failed; reads one row per failing test."""
    failed = {r["test"]: r["failures"] for r in summary.filter(F.col("failures") > 0).collect()}
    if failed:
        raise QualityGateError(failed)


ROW_TESTS = "row_tests"


def store_failures(suites: Sequence[Suite], root: str) -> None:
    """Write the failing rows of every test below ``root``.

    All row-level tests of a table share one scan and one folder, ``<table>/row_tests/test=<name>``; a
    row that fails several tests is stored under each.  Other tests get ``<table>/<name>``.
    """
    for suite in suites:
        if suite.rows:
            failed = F.array_compact(F.array(*[F.when(p, name) for name, p in suite.rows.items()]))
            failing = suite.df.withColumn("test", F.explode(failed))
            failing.write.mode("overwrite").partitionBy("test").parquet(f"{root}/{suite.table}/{ROW_TESTS}")
        for name, failing in suite.single().items():
            failing.write.mode("overwrite").parquet(f"{root}/{suite.table}/{name}")


def read_failures(suite: Suite, root: str, name: str) -> DataFrame:
    """The stored failing rows of one test."""
    reader, base = suite.df.sparkSession.read, f"{root}/{suite.table}"
    if name not in suite.rows:
        return reader.parquet(f"{base}/{name}")
    schema = suite.df.withColumn("test", F.lit("")).schema
    return reader.schema(schema).parquet(f"{base}/{ROW_TESTS}").filter(F.col("test") == name).drop("test")
