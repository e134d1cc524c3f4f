"""Load hourly files into the raw table: scan, parse, quarantine, upsert, audit."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import as_of_timestamp
from ..functions.calendar import AsOf
from ..operators.upsert import UPDATE_COLUMNS, upsert_raw
from ..schemas import RAW_KEY
from ..sources.event_files import file_name, flatten_events, parse_lines, scan_event_files
from ..sources.scratch import staged

AUDIT = (
    "source_file string, table_name string, rows_inserted long, rows_failed long, bytes_processed long, "
    "file_size_mb double, duration_seconds double, success boolean, error string, loaded_at timestamp"
)


@dataclass(frozen=True)
class LoadMetrics:
    rows_inserted: int
    rows_failed: int
    bytes_processed: int
    duration_seconds: float
    table_name: str = "raw.github_events"
    success: bool = True


def load_lines(
    spark: SparkSession,
    lines: DataFrame,
    raw_path: str,
    run_at: AsOf = None,
    update_columns: Sequence[str] = UPDATE_COLUMNS,
    quarantine_path: str | None = None,
    audit_path: str | None = None,
) -> LoadMetrics:
    """Upsert (value, source_file) lines; rejected lines are appended to ``quarantine_path``.

    The text is parsed once into a staged table, whose write also observes the counts; the passes of
    the upsert then read parquet.  With ``audit_path``, a row per file is appended there once the rows are in the table.
    """
    started = time.monotonic()
    rejected = F.col("reject_reason").isNotNull()
    observed = Observation()
    parsed = parse_lines(lines).observe(
        observed,
        F.count_if(rejected).alias("failed"),
        F.sum(F.coalesce(F.octet_length("value"), F.lit(0)) + 1).alias("bytes"),
    )
    rejected_text = F.when(rejected, F.col("value")).alias("value")
    line_bytes = (F.coalesce(F.octet_length("value"), F.lit(0)) + 1).alias("line_bytes")
    flat = flatten_events(parsed, F.col("reject_reason"), rejected_text, line_bytes)
    with staged(flat, "load") as table:
        good = table.filter(~rejected).drop("reject_reason", "value", "line_bytes")
        inserted = upsert_raw(spark, raw_path, good, run_at, update_columns)
        counts = observed.get
        if quarantine_path and counts["failed"]:
            bad = table.filter(rejected).select("source_file", "value", "reject_reason")
            bad.write.mode("append").parquet(quarantine_path)
        if audit_path:
            loaded = F.struct(*RAW_KEY)
            per_file = table.groupBy("source_file").agg(
                F.count_distinct(F.when(~rejected, loaded)).alias("rows_inserted"),
                F.count_if(rejected).alias("rows_failed"),
                F.sum("line_bytes").alias("bytes_processed"),
            )
            _audit(per_file, time.monotonic() - started, run_at).write.mode("append").parquet(audit_path)
    return LoadMetrics(inserted, counts["failed"], counts["bytes"] or 0, time.monotonic() - started)


def _audit(per_file: DataFrame, seconds: float | None, run_at: AsOf, success: bool = True) -> DataFrame:
    """Per-file counts as audit rows.  Files of one load are read together, so they share its duration."""
    return per_file.select(
        "source_file",
        F.lit(LoadMetrics.table_name).alias("table_name"),
        *[F.col(c).cast("long").alias(c) for c in ("rows_inserted", "rows_failed", "bytes_processed")],
        (F.col("bytes_processed") / F.lit(1e6)).cast("double").alias("file_size_mb"),
        F.lit(seconds).cast("double").alias("duration_seconds"),
        F.lit(success).alias("success"),
        (F.lit(None).cast("string") if success else F.col("error")).alias("error"),
        as_of_timestamp(run_at).alias("loaded_at"),
    )


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> list[tuple[str, str]]:
    """(path, hourly name) of every file, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths if isinstance(paths, str) else list(paths))
    return sorted(tuple(r) for r in files.select("path", file_name()).collect())


def broken_files(spark: SparkSession, files: Sequence[tuple[str, str]]) -> dict[str, str]:
    """path -> error of the files that cannot be read to their end.

    Groups of files are read as one job each and halved while they fail, so a few broken files among many take few jobs.
    """
    found, groups = {}, [[path for path, _ in files]]
    while groups:
        group = groups.pop()
        try:
            spark.read.text(group).write.format("noop").mode("overwrite").save()
        except Exception as failed:  # noqa: BLE001  whatever it is, it is the outcome of some file of the group
            if len(group) > 1:
                groups += [group[: len(group) // 2], group[len(group) // 2 :]]
            else:
                causes = [line for line in str(failed).splitlines() if "Caused by" in line] or str(failed).splitlines()
                found[group[0]] = causes[-1].strip()[:500]
    return found


def ingest_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    raw_path: str,
    run_at: AsOf = None,
    update_columns: Sequence[str] = UPDATE_COLUMNS,
    quarantine_path: str | None = None,
    spread: int | None = None,
    audit_path: str | None = None,
) -> LoadMetrics:
    """Load one or many hourly files.

    A gzip file is read by one task.  For loads of fewer files than cores, ``spread`` shuffles the text to
    so many tasks before parsing it; by default lines are parsed where they are read.

    Without ``audit_path`` a broken file ends the load.  With it, files that cannot be read are left out, the others
    are loaded, and every file gets a row of its outcome (schema AUDIT) in the table there; ``success`` of the result
    tells whether all were read.  Which files are broken is only asked once a load has failed.
    """

    def load(chosen: str | Sequence[str]) -> LoadMetrics:
        lines = scan_event_files(spark, chosen)
        if spread:
            lines = lines.repartition(spread)
        return load_lines(spark, lines, raw_path, run_at, update_columns, quarantine_path, audit_path)

    if audit_path is None:
        return load(paths)
    started = time.monotonic()
    try:
        return load(paths)
    except Exception:
        files = list_files(spark, paths)
        broken = broken_files(spark, files)
        if not broken:
            raise
    rest = [path for path, _ in files if path not in broken]
    done = load(rest) if rest else LoadMetrics(0, 0, 0, 0.0)
    outcomes = [(name, 0, 0, 0, broken[path]) for path, name in files if path in broken]
    failed = spark.createDataFrame(outcomes, "source_file string, rows_inserted long, rows_failed long, bytes_processed long, error string")
    seconds = time.monotonic() - started
    _audit(failed, seconds, run_at, success=False).write.mode("append").parquet(audit_path)
    return LoadMetrics(done.rows_inserted, done.rows_failed, done.bytes_processed, seconds, success=False)


def read_audit(spark: SparkSession, audit_path: str) -> DataFrame:
    return spark.read.schema(AUDIT).parquet(audit_path)
