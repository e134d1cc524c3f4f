"""Ordered build: freshness, staging, staging tests, marts, marts tests.

Every model is written and read back, so each step starts from files: no lineage reaches past one
step, and a lost executor costs only its own tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import AsOf
from ..operators.checks import Suite, quality_gate, source_freshness, store_layer, stored_counts
from ..operators.distinct_states import add_numbers, daily_bitmaps
from ..operators.incremental import drop_expired_partitions, incremental_filter
from ..sources.manifest import LoadManifest
from ..sources.raw_events import scan_raw
from ..sources.scratch import staged
from ..sources.seeds import event_categories
from ..sources.tables import Warehouse, date_folders, delete_folder, write_by_date, write_clustered, write_table
from . import marts, staging
from .quality_suites import marts_suites, reference_suite, source_suite, staging_suites
from .snapshots import build_snapshots

RAW_TABLE = "raw.github_events"
STAGING = ["stg_actors", "stg_repositories", "stg_organizations"]
DIMENSIONS = ["dim_actors", "dim_repositories", "dim_organizations"]
DAILY = ["agg_event_type_daily", "agg_repository_daily", "agg_actor_daily"]


#: Models of one layer that do not depend on each other are built this many at a time.
PARALLEL_BUILDS = 4


class StaleSourceError(RuntimeError):
    """The raw table was last loaded longer ago than the error threshold."""


def _together(*builds: Callable[[], None]) -> None:
    """Submit independent builds as concurrent Spark jobs, so one model's last tasks do not leave the
    cluster idle; the first error is raised once all have ended."""
    with ThreadPoolExecutor(PARALLEL_BUILDS) as pool:
        started = [pool.submit(build) for build in builds]
    for build in started:
        build.result()


ACTIVITY = "staging.activity_days"
#: Numbers of the entities, and per day the numbers seen (operators.distinct_states).
ENTITY_NUMBERS = "staging.entity_numbers"
DAILY_BITMAPS = "staging.daily_bitmaps"
#: The number of the last note of the raw table's manifest that a finished build has seen.
BUILD_PROGRESS = "staging.build_progress"
#: Instead of that, for a raw table without a manifest: a checksum per date.
BUILD_STATE = "staging.build_state"
_STATE = "event_date date, n_rows long, newest timestamp, stamps long"


def date_state(raw: DataFrame) -> DataFrame:
    """Per date, what changes whenever a load adds, updates or removes rows of it; payloads are not read."""
    columns = ["event_id", "event_type", "actor_id", "repo_id", "org_id", "updated_at"]
    stamp = F.pmod(F.xxhash64(*columns), F.lit(1 << 31))
    return raw.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("updated_at").alias("newest"), F.sum(stamp).alias("stamps")
    )


def touched_dates(warehouse: Warehouse, state: DataFrame) -> list[dt.date]:
    """Dates whose rows differ from those of the last finished build, vanished dates included."""
    if not warehouse.exists(f"{BUILD_STATE}/_SUCCESS"):
        return [r[0] for r in state.select("event_date").collect()]
    before = warehouse.read(BUILD_STATE)
    same = state.join(before, state.columns, "left_semi")
    either = state.select("event_date").union(before.select("event_date")).distinct()
    return [r[0] for r in either.join(same, "event_date", "left_anti").collect()]


def noted_dates(warehouse: Warehouse, upto: int) -> list[dt.date]:
    """Dates that loads have touched since the last finished build, from the raw table's manifest; all dates if
    there was none.  No event is read."""
    raw = warehouse.path(RAW_TABLE)
    if warehouse.exists(f"{BUILD_PROGRESS}/_SUCCESS"):
        seen = warehouse.read(BUILD_PROGRESS).first()["load"]
        return LoadManifest(warehouse.spark, raw).dates(seen, upto)
    built = warehouse.path("staging.stg_github_events") if warehouse.exists("staging.stg_github_events") else raw
    return sorted({*date_folders(warehouse.spark, raw), *date_folders(warehouse.spark, built)})


def _to_build(spark: SparkSession, warehouse: Warehouse) -> tuple[list[dt.date], Callable[[], None]]:
    """Touched dates as of now, and what notes them as built once the build has finished.  What a load adds
    meanwhile belongs to the next build."""
    manifest = LoadManifest(spark, warehouse.path(RAW_TABLE))
    if manifest.exists():
        newest = manifest.newest()
        progress = spark.createDataFrame([(newest,)], "load long")
        return noted_dates(warehouse, newest), lambda: write_table(progress, warehouse.path(BUILD_PROGRESS))
    state = spark.createDataFrame(date_state(scan_raw(spark, warehouse.path(RAW_TABLE))).collect(), _STATE)
    return touched_dates(warehouse, state), lambda: write_table(state, warehouse.path(BUILD_STATE))


def _drop_emptied(warehouse: Warehouse, table: str, dates: list[dt.date] | None, built: DataFrame) -> None:
    """Replacing dates leaves a date alone that has no rows any more; ``built`` has rows on those of ``dates`` that do."""
    if not dates or not warehouse.exists(table):
        return
    left = {r[0] for r in built.select("event_date").distinct().collect()}
    folders = date_folders(warehouse.spark, warehouse.path(table))
    for date in set(dates) - left:
        if date in folders:
            delete_folder(warehouse.spark, folders[date])


def _pending(
    warehouse: Warehouse,
    table: str,
    source: DataFrame,
    mode: str,
    lookback_days: int,
    dates: list[dt.date] | None = None,
) -> tuple[DataFrame, str]:
    """The source rows to build a date-partitioned model from, and how to write the result.

    A model's rows of one date depend only on source rows of that date, and whole dates are
    recomputed (distinct counts do not add up), so replacing date folders merges by key without
    reading the target.
    """
    if mode == "full" or not warehouse.exists(f"{table}/_SUCCESS"):
        return source, "overwrite"
    if mode == "touched":
        return source.filter(F.col("event_date").isin(dates)), "replace_dates"
    newest = warehouse.newest_date(table)
    selected = incremental_filter(source, newest, mode=mode, lookback_days=lookback_days)
    return selected, "append" if mode == "strict" else "replace_dates"


def build_staging(
    spark: SparkSession,
    warehouse: Warehouse,
    mode: str = "full",
    lookback_days: int = 7,
    dates: list[dt.date] | None = None,
    categories_csv: str | None = None,
) -> None:
    """Staged events and their activity days, in full or for some dates, the three entity models and the category lookup.

    Staging is row-wise over a date-partitioned table, so it is written without a shuffle.  The entity models merge
    the activity days of all dates; of the events, only the dates that are built are read.
    """
    table = "staging.stg_github_events"
    source = scan_raw(spark, warehouse.path(RAW_TABLE))
    staged_rows, write_mode = _pending(
        warehouse, table, staging.staging_events(source), mode, lookback_days, dates
    )
    _drop_emptied(warehouse, table, dates, staged_rows)
    write_by_date(staged_rows, warehouse.path(table), write_mode, rebalance=False)
    events, write_mode = _pending(warehouse, ACTIVITY, warehouse.read(table), mode, lookback_days, dates)
    _drop_emptied(warehouse, ACTIVITY, dates, events)
    write_by_date(staging.activity_days(events), warehouse.path(ACTIVITY), write_mode)
    days = warehouse.read(ACTIVITY)

    def build(model: str) -> None:
        write_table(getattr(staging, model)(days), warehouse.path(f"staging.{model}"))

    def seed() -> None:
        write_table(event_categories(spark, categories_csv), warehouse.path("seeds.event_type_categories"))

    _together(*[partial(build, model) for model in STAGING], seed)


def build_bitmaps(
    warehouse: Warehouse, mode: str = "full", lookback_days: int = 7, dates: list[dt.date] | None = None
) -> None:
    """Bitmaps of the entities that each day has seen, in full or for some dates, from the activity days."""
    days, write_mode = _pending(warehouse, DAILY_BITMAPS, warehouse.read(ACTIVITY), mode, lookback_days, dates)
    numbers = add_numbers(warehouse.spark, days, warehouse.path(ENTITY_NUMBERS))
    _drop_emptied(warehouse, DAILY_BITMAPS, dates, days)
    write_by_date(daily_bitmaps(days, numbers), warehouse.path(DAILY_BITMAPS), write_mode)


def build_fact(
    warehouse: Warehouse,
    run_at: AsOf = None,
    mode: str = "lookback",
    lookback_days: int = 7,
    dates: list[dt.date] | None = None,
) -> None:
    """The fact table.  Events, payloads included, stay where they are unless so many repositories
    were renamed that their names cannot be broadcast."""
    table = "marts.fct_github_events"
    events, write_mode = _pending(
        warehouse, table, warehouse.read("staging.stg_github_events"), mode, lookback_days, dates
    )
    _drop_emptied(warehouse, table, dates, events)
    repositories = warehouse.read("staging.stg_repositories")
    with staged(marts.repository_corrections(events, repositories), "corrections") as corrections:
        if corrections.count() <= marts.BROADCAST_ROWS:
            fact = marts.fct_from_own_names(events, corrections, run_at)
            write_clustered(fact, warehouse.path(table), write_mode, rebalance=False)
        else:
            fact = marts.fct_github_events(events, repositories, run_at)
            write_clustered(fact, warehouse.path(table), write_mode)


def build_marts(
    warehouse: Warehouse,
    run_at: AsOf = None,
    mode: str = "lookback",
    lookback_days: int = 7,
    dates: list[dt.date] | None = None,
) -> None:
    """Dimensions in full; fact and daily aggregates incrementally."""

    def build_dimension(name: str, model: str) -> None:
        built = getattr(marts, name)(warehouse.read(f"staging.{model}"), run_at)
        write_table(built, warehouse.path(f"marts.{name}"))

    def build_daily(name: str) -> None:
        fact = warehouse.read("marts.fct_github_events")
        events, write_mode = _pending(warehouse, f"marts.{name}", fact, mode, lookback_days, dates)
        counted = events.filter("repo_id is not null") if name == "agg_repository_daily" else events
        _drop_emptied(warehouse, f"marts.{name}", dates, counted)
        write_by_date(getattr(marts, name)(events, run_at), warehouse.path(f"marts.{name}"), write_mode)

    dimensions = [partial(build_dimension, *pair) for pair in zip(DIMENSIONS, STAGING, strict=True)]
    _together(partial(build_fact, warehouse, run_at, mode, lookback_days, dates), *dimensions)
    _together(*[partial(build_daily, name) for name in DAILY])


def staging_tests(
    spark: SparkSession, warehouse: Warehouse, as_of: AsOf = None, dates: list[dt.date] | None = None
) -> list[Suite]:
    """Tests of the raw rows (of ``dates``, if given: the others were tested when they were built) and of staging."""
    read = warehouse.read
    raw = scan_raw(spark, warehouse.path(RAW_TABLE))
    if dates is not None:
        raw = raw.filter(F.col("event_date").isin(dates))
    suites = staging_suites(
        read("staging.stg_github_events"), *[read(f"staging.{n}") for n in STAGING], as_of=as_of
    )
    return [source_suite(raw), *suites]


def marts_tests(warehouse: Warehouse) -> list[Suite]:
    read = warehouse.read
    return marts_suites(read("marts.fct_github_events"), *[read(f"marts.{n}") for n in DIMENSIONS + DAILY])


def reference_tests(warehouse: Warehouse) -> list[Suite]:
    """Orphan tests, as warnings."""
    read = warehouse.read
    return [reference_suite(read("marts.fct_github_events"), *[read(f"marts.{n}") for n in DIMENSIONS])]


def build_all(
    spark: SparkSession,
    warehouse: Warehouse,
    as_of: AsOf = None,
    run_at: AsOf = None,
    mode: str = "touched",
    lookback_days: int = 7,
    gate: bool = True,
    keep_days: int | None = None,
    snapshots: bool = False,
    bitmaps: bool = False,
    categories_csv: str | None = None,
) -> DataFrame:
    """Build everything from ``raw.github_events``; returns (table_name, row_count).

    ``mode``: ``touched`` builds every date again that a load has touched since the last finished build,
    however old, and drops dates that have become empty; touched dates come from the raw table's manifest (from
    checksums over all of it, if it was written without one); ``full`` rebuilds; ``lookback`` builds the newest ``lookback_days`` dates again;
    ``strict`` rebuilds staging and adds only new dates to the marts.  With ``gate``, a stale source
    or a failing staging test stops the build before the marts, and a failing mart test raises at the
    end; failing rows and counts are in ``test_results.<layer>_failures`` and ``_summary`` either way.

    ``keep_days`` drops raw dates past retention first; with the manifest, the next ``touched`` build (this one too) drops
    them from the models.  ``snapshots`` merges the tested entity models into their histories; ``bitmaps`` keeps
    states of distinct counts per day (always, once there are some).  ``categories_csv`` is a file or folder that the
    executors can read; without it the lookup is the built-in one.
    """
    if keep_days is not None:
        drop_expired_partitions(spark, warehouse.path(RAW_TABLE), keep_days, as_of)
    if gate:
        if load_freshness(spark, warehouse, as_of).first()["status"] == "error":
            raise StaleSourceError("raw.github_events has not been loaded recently")
    dates, note_built = _to_build(spark, warehouse) if mode == "touched" else (None, None)
    build_staging(spark, warehouse, "full" if mode == "strict" else mode, lookback_days, dates, categories_csv)
    if bitmaps or warehouse.exists(DAILY_BITMAPS):
        build_bitmaps(warehouse, "full" if mode == "strict" else mode, lookback_days, dates)
    _finish_layer(staging_tests(spark, warehouse, as_of, dates), warehouse, "staging", gate)
    if snapshots:
        build_snapshots(warehouse, as_of)
    build_marts(warehouse, run_at, mode, lookback_days, dates)
    _finish_layer(reference_tests(warehouse), warehouse, "references", False)
    _finish_layer(marts_tests(warehouse), warehouse, "marts", gate)
    if note_built:
        note_built()
    return table_counts(warehouse)


def load_freshness(spark: SparkSession, warehouse: Warehouse, as_of: AsOf = None) -> DataFrame:
    """Verdict on the age of the newest load, from the manifest; without one, from the load stamps of all raw rows."""
    manifest = LoadManifest(spark, warehouse.path(RAW_TABLE))
    if manifest.exists():
        return source_freshness(manifest.loads(), "loaded_at", as_of=as_of)
    return source_freshness(scan_raw(spark, warehouse.path(RAW_TABLE)), as_of=as_of)


def _finish_layer(suites: list[Suite], warehouse: Warehouse, layer: str, gate: bool) -> None:
    """Run a layer's tests: failing rows first, the counts from them."""
    rows, counts = (warehouse.path(f"test_results.{layer}_{kind}") for kind in ("failures", "summary"))
    store_layer(suites, rows)
    write_table(stored_counts(suites, rows), counts)
    if gate:
        quality_gate(warehouse.read(f"test_results.{layer}_summary"))


def table_counts(warehouse: Warehouse) -> DataFrame:
    """Row count of every built table, from parquet footers."""
    names = [f"staging.{n}" for n in ["stg_github_events", *STAGING]]
    names += [f"marts.{n}" for n in [*DIMENSIONS, "fct_github_events", *DAILY]]
    counts = [
        warehouse.read(n).agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n in names
    ]
    return reduce(DataFrame.unionByName, counts)
