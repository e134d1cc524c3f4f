"""Load whatever hourly files have arrived since the last run.

The stream's checkpoint remembers which files were loaded.  A micro-batch that is repeated after a
failure is upserted again, which changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import load_lines
from ..sources.event_files import file_name


def load_new_files(
    spark: SparkSession,
    landing: str,
    raw_path: str,
    checkpoint: str,
    quarantine_path: str | None = None,
    max_files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Start a run over all unseen files below ``landing``; it stops when they are loaded.

    ``checkpoint`` must be a folder on shared storage that outlives the run.
    """
    lines = (
        spark.readStream.option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .option("maxFileAge", "36500d")  # the default leaves out files a week older than the newest
        .text(landing)
        .select("value", file_name())
    )

    def load(batch: DataFrame, _: int) -> None:
        load_lines(batch.sparkSession, batch, raw_path, quarantine_path=quarantine_path)

    return (
        lines.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
