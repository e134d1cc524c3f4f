"""Type-2 history as a stored table, merged once per build.

Open and closed versions are in two partitions.  A merge reads the open ones only, which are as many as the source has
keys; versions that it closes are added to the closed partition, and the open one is replaced, both by one switch
(``sources.tables``), so the history of all closed versions is neither read nor written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import AsOf
from ..operators.incremental import snapshot_merge
from ..sources.tables import Warehouse, path_exists, read_by_date, replace_partition

OPEN = "is_open"
#: Models with a history: their key and the time that says whether a row has changed.
SNAPSHOTS = {
    "stg_actors": ("actor_id", "last_seen_at"),
    "stg_repositories": ("repo_id", "last_seen_at"),
    "stg_organizations": ("org_id", "last_seen_at"),
}


def store_snapshot(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str,
    updated_at: str,
    close_missing: bool = False,
    as_of: AsOf = None,
) -> None:
    """Merge the current state (``source``, one row per key) into the history at ``path``.

    A key whose ``updated_at`` advanced gets a new version; a key missing from the source stays open, or is closed as of
    ``as_of`` with ``close_missing`` and opened anew should it return.  Merging the same state again changes nothing.
    """
    known = read_snapshot(spark, path).filter(OPEN).drop(OPEN) if path_exists(spark, path) else None
    versions = snapshot_merge(known, source, key, updated_at, close_missing, as_of)
    replace_partition(versions.withColumn(OPEN, F.col("valid_to").isNull()), path, OPEN, "true")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """All versions; a filter on ``is_open`` prunes the other partition."""
    return read_by_date(spark, path)


def build_snapshots(warehouse: Warehouse, as_of: AsOf = None, close_missing: bool = False) -> None:
    """Merge the entity models of this build into their histories, ``snapshots.<model>``."""
    for model, (key, updated_at) in SNAPSHOTS.items():
        source = warehouse.read(f"staging.{model}")
        store_snapshot(warehouse.spark, warehouse.path(f"snapshots.{model}"), source, key, updated_at, close_missing, as_of)
