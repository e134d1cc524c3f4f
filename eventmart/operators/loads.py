"""Load planning and load audit over hourly files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_of_timestamp, utc_date, utc_floor, utc_hour
from ..functions.calendar import AsOf
from ..sources.event_files import parse_lines
from ..sources.raw_events import scan_raw
from ..sources.tables import date_folders
from .ranking import latest_row

EXTENSION = ".json.gz"
DATE_HOUR = r"^\d{4}-\d{2}-\d{2}-\d{1,2}$"


def parse_hour(label: Column) -> Column:
    """``yyyy-MM-dd-H`` text to a timestamp, UTC; NULL if malformed or not a calendar hour."""
    utc = F.concat(label, F.lit(" Z"))
    return F.when(label.rlike(DATE_HOUR), F.try_to_timestamp(utc, F.lit("yyyy-MM-dd-H X")))


def hour_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One (start_hour, end_hour) row from ``yyyy-MM-dd-H`` labels."""
    return spark.range(1).select(
        parse_hour(F.lit(start)).alias("start_hour"), parse_hour(F.lit(end)).alias("end_hour")
    )


def hours_to_process(ranges: DataFrame, zero_padded: bool = False) -> DataFrame:
    """Every hour of a (start_hour, end_hour) row, ends included: (hour, date_hour).

    A range that ends before it starts has no hours.
    """
    hours = F.when(
        F.col("start_hour") <= F.col("end_hour"),
        F.sequence("start_hour", "end_hour", F.expr("INTERVAL 1 HOUR")),
    )
    number = utc_hour("hour").cast("string")
    number = F.lpad(number, 2, "0") if zero_padded else number
    return ranges.select(F.explode(hours).alias("hour")).withColumn(
        "date_hour", F.concat_ws("-", utc_date("hour").cast("string"), number)
    )


def newest_rows(spark: SparkSession, raw_path: str) -> DataFrame:
    """Of the stored raw table, the newest date that has rows; all that ``last_processed_hour`` needs."""
    raw = scan_raw(spark, raw_path)
    for date in sorted(date_folders(spark, raw_path), reverse=True):
        rows = raw.filter(F.col("event_date") == F.lit(date))
        if not rows.isEmpty():
            return rows
    return raw.filter(F.lit(False))


def last_processed_hour(raw: DataFrame) -> DataFrame:
    """One row: the newest event's source file and the hour in its name; NULLs for an empty table."""
    label = F.replace(F.col("source_file"), F.lit(EXTENSION), F.lit(""))
    return latest_row(raw).withColumn("last_hour", parse_hour(label))


def load_range(
    raw: DataFrame, as_of: AsOf = None, backfill_start: str = "", backfill_end: str = ""
) -> DataFrame:
    """The hours to load next as one (start_hour, end_hour) row, or no row if up to date.

    A readable explicit range wins; otherwise from the hour after the last processed one (or today
    00:00 for an empty table) to two hours before ``as_of``.
    """
    now = as_of_timestamp(as_of)
    in_order = F.col("start_hour") <= F.col("end_hour")
    explicit = hour_range(raw.sparkSession, backfill_start.strip(), backfill_end.strip()).dropna()
    if not explicit.isEmpty():  # without a look at the table
        return explicit.filter(in_order)
    one_hour = F.expr("INTERVAL 1 HOUR")
    next_hour = F.coalesce(F.col("last_hour") + one_hour, utc_floor(now, 86_400))
    latest = utc_floor(now - F.expr("INTERVAL 2 HOURS"), 3_600)
    return (
        last_processed_hour(raw)
        .select(
            next_hour.alias("start_hour"),
            latest.alias("end_hour"),
        )
        .filter(in_order)
    )


def missing_hours(raw: DataFrame, ranges: DataFrame, skew_days: int = 1) -> DataFrame:
    """Hours of the range without a single raw row, gaps in the middle included.

    Only dates of the range are read, and ``skew_days`` on both sides for events whose own date is not
    that of their file.  The driver reads the range's two ends.
    """
    first, last = ranges.agg(F.min(utc_date("start_hour")), F.max(utc_date("end_hour"))).first()
    if first is not None and last is not None:
        margin = dt.timedelta(days=skew_days)
        raw = raw.filter(F.col("event_date").between(F.lit(first - margin), F.lit(last + margin)))
    loaded = raw.select(F.replace(F.col("source_file"), F.lit(EXTENSION), F.lit("")).alias("date_hour"))
    return hours_to_process(ranges).join(loaded.distinct(), "date_hour", "left_anti")


def date_hour_to_path(df: DataFrame, label: str = "date_hour", root: str = "") -> DataFrame:
    """Add ``is_valid`` and the hourly file's ``path``, NULL for labels that are no calendar hour."""
    valid = parse_hour(F.col(label)).isNotNull()
    path = F.concat(F.lit(root), F.col(label), F.lit(EXTENSION))
    return df.withColumn("is_valid", F.coalesce(valid, F.lit(False))).withColumn(
        "path", F.when(F.col("is_valid"), path)
    )


def load_metrics(lines: DataFrame, table_name: str = "raw.github_events") -> DataFrame:
    """Per file: distinct events loaded, lines rejected, and uncompressed bytes with line ends."""
    parsed = parse_lines(lines).select(
        "source_file",
        F.octet_length("value").alias("bytes"),
        F.col("reject_reason").isNotNull().alias("rejected"),
        F.when(F.col("reject_reason").isNull(), F.col("event.id")).alias("id"),
        utc_date("event.created_at").alias("date"),
    )
    return parsed.groupBy("source_file").agg(
        F.lit(table_name).alias("table_name"),
        F.count_distinct(F.when(F.col("id").isNotNull(), F.struct("id", "date"))).alias("rows_inserted"),
        F.count_if("rejected").alias("rows_failed"),
        F.sum(F.coalesce(F.col("bytes"), F.lit(0)) + 1).alias("bytes_processed"),
    )


def load_summary(loads: DataFrame) -> DataFrame:
    """One row over per-hour results (rows_inserted, file_size_mb); an hour without rows has failed."""
    ok = F.coalesce(F.col("rows_inserted"), F.lit(0)) > 0
    totals = loads.agg(
        F.count_if(ok).alias("hours_processed"),
        F.count_if(~ok).alias("hours_failed"),
        F.coalesce(F.sum("rows_inserted"), F.lit(0)).alias("total_rows_inserted"),
        F.bround(F.coalesce(F.sum(F.col("file_size_mb").cast("decimal(28,9)")), F.lit(0)), 2)
        .cast("double")
        .alias("total_size_mb"),
    )
    average = F.when(
        F.col("hours_processed") > 0,
        F.bround(F.col("total_rows_inserted").cast("decimal(20,0)") / F.col("hours_processed"), 0),
    ).otherwise(0)
    return totals.withColumn("average_rows_per_hour", average.cast("long")).withColumn(
        "success", F.col("hours_failed") == 0
    )
