"""A table in monthly partitions with a default partition and retention, both applied as rows are written.

Rows of the declared months go to ``partition_name=yyyy_MM/partition_date=...``.  Any other date (a broken clock's 1970, a
date far ahead, none) goes to the one folder of ``partition_name=default``, so junk dates make no folders and stay there
to be looked at.  Dates of declared months that are past the retention period are not written, and what has passed it
since is dropped as whole folders, without reading or moving data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import AsOf, utc_day
from ..operators.incremental import route_partitions
from .tables import delete_folder, path_exists

DEFAULT = "default"
#: Rows of one partition that are written together; what one map task has for a piece cannot be cut any further.
PIECE_ROWS = 1 << 19
_PARTITIONS = ["partition_name", "partition_date"]


def _cutoff(keep_days: int, as_of: AsOf) -> dt.date:
    return utc_day(as_of) - dt.timedelta(days=keep_days)


def _with_piece(routed: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``__piece``, which deals the rows of a partition of over PIECE_ROWS rows into pieces by their ``columns``."""
    counts = routed.groupBy(*_PARTITIONS).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > PIECE_ROWS)
    large = counts.select(F.struct(*_PARTITIONS).alias("__at"), F.ceil(F.col("__n") / PIECE_ROWS).alias("__ways"))
    found = routed.join(F.broadcast(large), F.struct(*_PARTITIONS).eqNullSafe(F.col("__at")), "left")
    piece = F.pmod(F.xxhash64(*columns), F.coalesce("__ways", F.lit(1).cast("long")))
    return found.withColumn("__piece", piece).drop("__at", "__ways")


def write_routed(
    df: DataFrame, path: str, first_month: AsOf, last_month: AsOf, keep_days: int | None = None, as_of: AsOf = None
) -> list[dt.date]:
    """Append rows to their partitions and drop expired ones; returns the dates that were dropped.

    ``event_date`` stays a column of the rows.  The default partition is never dropped.  A partition that holds most
    rows is cut into several tasks, also if all of them come from one map task; for that, rows are counted first.
    """
    routed = route_partitions(df, first_month, last_month)
    declared = F.col("partition_name") != DEFAULT
    if keep_days is not None:
        routed = routed.filter(~declared | (F.col("event_date") >= F.lit(_cutoff(keep_days, as_of))))
    routed = routed.withColumn("partition_date", F.when(declared, F.col("event_date")))
    dealt = _with_piece(routed, [c for c, kind in df.dtypes if "map<" not in kind]).hint("rebalance", *_PARTITIONS, "__piece")
    dealt.drop("__piece").write.partitionBy(*_PARTITIONS).mode("append").parquet(path)
    return drop_expired(df.sparkSession, path, keep_days, as_of)


def drop_expired(spark: SparkSession, path: str, keep_days: int | None, as_of: AsOf = None) -> list[dt.date]:
    """Delete the folders of declared dates past retention; returns their dates."""
    if keep_days is None or not path_exists(spark, path):
        return []
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    months = [s.getPath() for s in files.listStatus(root) if s.getPath().getName().startswith("partition_name=")]
    gone = []
    for month in months:
        dates = [] if month.getName() == f"partition_name={DEFAULT}" else files.listStatus(month)
        for status in dates:
            date = dt.date.fromisoformat(status.getPath().getName().partition("=")[2])
            if date < _cutoff(keep_days, as_of):
                delete_folder(spark, status.getPath().toString())
                gone.append(date)
    return sorted(gone)


def read_routed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows (``schema`` as they were written) with partition_name; a filter on partition_name or partition_date
    prunes folders."""
    return spark.read.schema(f"{schema}, partition_name string, partition_date date").parquet(path)
