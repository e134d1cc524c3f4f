"""Incremental builds, retention, partition routing and snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_of_date, as_of_timestamp
from ..functions.calendar import AsOf, utc_day
from ..schemas import INCREMENTAL_FLOOR
from ..sources.manifest import LoadManifest
from ..sources.tables import date_folders, delete_folder
from .filters import trailing_days


def incremental_filter(
    source: DataFrame,
    target: DataFrame | dt.date | None,
    floor: str = INCREMENTAL_FLOOR,
    mode: str = "lookback",
    lookback_days: int = 7,
) -> DataFrame:
    """Source rows an incremental build should process.

    ``strict``: dates after the target's newest one, so rows that reach an already built date later
    are never picked up.  ``lookback``: the newest ``lookback_days`` built dates again as well.  An
    empty target counts as built up to ``floor``.  ``target`` is the built table or its newest date
    (None: empty).  That date is the one value the driver reads; as a literal it prunes the source's
    folders.
    """
    if mode not in ("strict", "lookback"):
        raise ValueError(f"unknown mode {mode!r}")
    newest = target.agg(F.max("event_date")).first()[0] if isinstance(target, DataFrame) else target
    if newest is None:
        newest = dt.date.fromisoformat(floor)
    elif mode == "lookback":
        newest = newest - dt.timedelta(days=lookback_days)
    return source.filter(F.col("event_date") > F.lit(newest))


def merge_by_key(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose (non-null) key is not in ``new``, plus all of ``new``."""
    kept = target.join(new.select(*keys), list(keys), "left_anti")
    return kept.select(*new.columns).unionByName(new)


def route_partitions(df: DataFrame, first_month: AsOf, last_month: AsOf) -> DataFrame:
    """Add ``partition_name``: ``yyyy_MM`` for the declared months, ``default`` for any other date."""
    month = F.trunc("event_date", "month")
    declared = month.between(F.trunc(as_of_date(first_month), "month"), F.trunc(as_of_date(last_month), "month"))
    return df.withColumn(
        "partition_name", F.when(declared, F.date_format("event_date", "yyyy_MM")).otherwise("default")
    )


def expire_partitions(df: DataFrame, keep_days: int | None, as_of: AsOf = None) -> DataFrame:
    """Rows still inside the retention period; ``None`` keeps everything."""
    return df if keep_days is None else trailing_days(df, keep_days, as_of)


def drop_expired_partitions(
    spark: SparkSession, path: str, keep_days: int | None, as_of: AsOf = None
) -> list[dt.date]:
    """Delete the table's expired date folders; returns their dates.  No data is read or moved."""
    if keep_days is None:
        return []
    cutoff = utc_day(as_of) - dt.timedelta(days=keep_days)
    expired = {date: folder for date, folder in date_folders(spark, path).items() if date < cutoff}
    for folder in expired.values():
        delete_folder(spark, folder)
    manifest = LoadManifest(spark, path)
    if expired and manifest.exists():
        manifest.note_dates(sorted(expired))
    return sorted(expired)


def snapshot_merge(
    snapshot: DataFrame | None,
    source: DataFrame,
    key: str,
    updated_at: str,
    close_missing: bool = False,
    as_of: AsOf = None,
) -> DataFrame:
    """Type-2 history by the timestamp strategy.

    ``source`` is the current state, one row per key.  A key whose ``updated_at`` advanced closes its
    open version and opens a new one; keys missing from the source stay open, or are closed as of ``as_of`` with
    ``close_missing``.  ``valid_to`` is NULL on the open version.  One join on the unique key, no per-key window.
    """
    columns = source.columns
    opened = source.select(
        *columns, F.col(updated_at).alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to")
    )
    if snapshot is None:
        return opened
    closed = snapshot.filter(F.col("valid_to").isNotNull()).select(*opened.columns)
    current = snapshot.filter(F.col("valid_to").isNull()).select(F.struct(*opened.columns).alias("old"))
    arriving = opened.select(F.struct(*opened.columns).alias("new"))
    old, new = F.col("old"), F.col("new")
    changed = new[updated_at] > old[updated_at]
    closing = F.when(changed, new[updated_at])
    if close_missing:
        closing = closing.when(new.isNull(), as_of_timestamp(as_of))
    kept = F.when(old.isNotNull(), old.withField("valid_to", closing))
    added = F.when(new.isNotNull() & (old.isNull() | changed), new)
    versions = current.join(arriving, old[key] == new[key], "full_outer").select(
        F.explode(F.array_compact(F.array(kept, added))).alias("version")
    )
    return closed.unionByName(versions.select("version.*"))
