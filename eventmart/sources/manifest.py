"""What loads have touched: an append-only record beside the raw table.

Every load notes the dates of its rows before it changes the table and again once it is done, each time as one small
file in a folder of the next number.  A build notes the highest number it has seen; dates noted since then are the ones
to build again.  Which dates changed is thus known from a few small files, however long the history.  A load that
broke off, or ran while a build was reading, has its first or its second note left over for the next build.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_of_timestamp
from ..functions.calendar import AsOf
from .tables import path_exists

_NOTES = "finished boolean, source_file string, event_date date, n_rows long, loaded_at timestamp"


class LoadManifest:
    """The notes of one raw table.  One writer at a time, as for the table itself."""

    def __init__(self, spark: SparkSession, raw_path: str):
        self.spark = spark
        self.path = f"{raw_path.rstrip('/')}.loads"

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def newest(self) -> int:
        """The highest number, from a folder listing; 0 without notes."""
        if not self.exists():
            return 0
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        listing = root.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(root)
        names = [status.getPath().getName() for status in listing]
        return max((int(n.partition("=")[2]) for n in names if n.startswith("load=")), default=0)

    def note(self, rows: DataFrame, finished: bool, run_at: AsOf = None) -> None:
        """Append ``source_file, event_date, n_rows``."""
        noted = rows.select(
            F.lit(finished).alias("finished"), "source_file", "event_date", "n_rows", as_of_timestamp(run_at).alias("loaded_at")
        )
        noted.coalesce(1).write.parquet(f"{self.path}/load={self.newest() + 1:012d}")

    def note_dates(self, dates: list[dt.date], run_at: AsOf = None) -> None:
        """For changes that are no loads of files, such as dates that were dropped."""
        rows = self.spark.createDataFrame([(None, d, 0) for d in dates], "source_file string, event_date date, n_rows long")
        self.note(rows, True, run_at)

    def read(self, after: int = 0) -> DataFrame:
        """Notes with their number ``load``; folders up to ``after`` are not read."""
        notes = self.spark.read.schema(f"{_NOTES}, load long").option("basePath", self.path).parquet(self.path)
        return notes.filter(F.col("load") > after)

    def dates(self, after: int, upto: int) -> list[dt.date]:
        """Dates noted under the numbers above ``after``, up to ``upto``: at most one value per calendar day."""
        return [r[0] for r in self.read(after).filter(F.col("load") <= upto).select("event_date").distinct().collect()]

    def loads(self) -> DataFrame:
        """Notes of finished loads of rows."""
        return self.read().filter("finished and n_rows > 0")
