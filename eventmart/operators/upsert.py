"""Idempotent upsert into the date-partitioned raw table.

Plain parquet has no MERGE, so a batch is routed: the files in which some of its keys already are get merged with it
and replaced, everything else is appended.  Hourly files normally hold new events only, so the usual load appends and
rewrites nothing, and one event delivered again costs its own file, not its date.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_of_timestamp
from ..functions.calendar import AsOf
from ..schemas import FLAT_COLUMNS, RAW, RAW_COLUMNS, RAW_KEY
from ..sources.manifest import LoadManifest
from ..sources.scratch import staged
from ..sources.tables import PARTITION, finish_replacement, path_exists, replace_files, write_by_date
from .ranking import first_per_key

#: Columns a re-delivered event may change.  created_at and ingested_at keep their first value.
UPDATE_COLUMNS = [
    "event_type",
    "actor_id",
    "actor_login",
    "repo_id",
    "repo_name",
    "org_id",
    "org_login",
    "is_public",
    "payload",
    "source_file",
]
#: The variant that also keeps the first payload.
UPDATE_COLUMNS_KEEP_PAYLOAD = [c for c in UPDATE_COLUMNS if c != "payload"]


def dedupe_batch(batch: DataFrame) -> DataFrame:
    """One row per key: the one from the latest file, then latest created_at, then largest payload."""
    newest = [F.desc("source_file"), F.desc("created_at"), F.desc("payload")]
    return first_per_key(batch, RAW_KEY, newest)


def merge_match(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Keys present on both sides.  Key columns only, so payloads are neither read nor shuffled."""
    return existing.select(*RAW_KEY).join(batch.select(*RAW_KEY), RAW_KEY, "left_semi")


def merge_batch(
    existing: DataFrame,
    batch: DataFrame,
    run_at: AsOf = None,
    update_columns: Sequence[str] = UPDATE_COLUMNS,
) -> DataFrame:
    """The rows after upserting ``batch`` (flat columns, any duplicates) into ``existing``."""
    now = as_of_timestamp(run_at)
    old = existing.select(*[F.col(c).alias(f"old_{c}") for c in RAW_COLUMNS])
    new = dedupe_batch(batch.select(*FLAT_COLUMNS)).select(
        *[F.col(c).alias(f"new_{c}") for c in FLAT_COLUMNS]
    )
    same_key = [F.col(f"old_{c}") == F.col(f"new_{c}") for c in RAW_KEY]
    existed, arrived = F.col("old_event_id").isNotNull(), F.col("new_event_id").isNotNull()

    def merged(name: str):
        if name == "ingested_at":
            return F.when(existed, F.col("old_ingested_at")).otherwise(now)
        if name == "updated_at":
            return F.when(arrived, now).otherwise(F.col("old_updated_at"))
        old_value, new_value = F.col(f"old_{name}"), F.col(f"new_{name}")
        if name in update_columns:
            return F.when(arrived, new_value).otherwise(old_value)
        return F.when(existed, old_value).otherwise(new_value)

    return old.join(new, same_key, "full_outer").select(*[merged(c).alias(c) for c in RAW_COLUMNS])


def stamp(batch: DataFrame, run_at: AsOf = None) -> DataFrame:
    """Flat rows -> raw rows of a first load."""
    now = as_of_timestamp(run_at)
    return batch.select(*FLAT_COLUMNS, now.alias("ingested_at"), now.alias("updated_at"))


def _dates(df: DataFrame) -> list[dt.date]:
    """Distinct dates, on the driver: at most one value per calendar day."""
    return [row[0] for row in df.select("event_date").distinct().collect()]


def upsert_raw(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    run_at: AsOf = None,
    update_columns: Sequence[str] = UPDATE_COLUMNS,
) -> int:
    """Upsert flat rows into the raw table at ``path``; returns the number of keys written.

    Running it again with the same batch gives the same table, so a load that was cut short is
    simply run again.  One writer at a time.  ``batch`` is scanned several times: stage it first if it
    is costly to compute.  The load's files and dates are noted in the table's manifest before and after.
    """
    batch = batch.select(*FLAT_COLUMNS)
    affected = batch.select(*RAW_KEY).distinct().count()
    if not affected:
        return 0
    touched = batch.groupBy("source_file", "event_date").agg(F.count(F.lit(1)).alias("n_rows"))
    with staged(touched, "touched") as touched:
        manifest = LoadManifest(spark, path)
        manifest.note(touched, False, run_at)
        _write_batch(spark, path, batch, _dates(touched), run_at, update_columns)
        manifest.note(touched, True, run_at)
    return affected


def _write_batch(
    spark: SparkSession, path: str, batch: DataFrame, arriving: list[dt.date], run_at: AsOf, update_columns: Sequence[str]
) -> None:
    if not path_exists(spark, path):
        write_by_date(stamp(dedupe_batch(batch), run_at), path, "append")
        return

    in_dates = lambda df, dates: df.filter(F.col("event_date").isin(dates))
    finish_replacement(spark, path)
    files = matched_files(in_dates(stored_rows(spark, path), arriving), batch)
    rewritten = sorted({r["event_date"] for r in files})
    fresh = [d for d in arriving if d not in set(rewritten)]
    if files:
        jvm = spark._jvm
        # the metadata column has the path as an address, with %20 for a space
        names = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["file"])).toString() for r in files]
        existing = spark.read.schema(RAW).option("basePath", path).parquet(*names).select(*RAW_COLUMNS)
        merged = merge_batch(existing, in_dates(batch, rewritten), run_at, update_columns)
        replace_files(merged.hint("rebalance", PARTITION), path, names, partition=PARTITION)
    if fresh:
        write_by_date(stamp(dedupe_batch(in_dates(batch, fresh)), run_at), path, "append")


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """Keys of the raw table with the file each one is in."""
    rows = spark.read.schema(RAW).parquet(path)
    return rows.select(*RAW_KEY, F.col("_metadata.file_path").alias("file"))


def matched_files(stored: DataFrame, batch: DataFrame) -> list:
    """Rows (event_date, file) of the files that hold a key of the batch: at most one per file of its dates."""
    hit = stored.join(batch.select(*RAW_KEY), RAW_KEY, "left_semi")
    return hit.select("event_date", "file").distinct().collect()
