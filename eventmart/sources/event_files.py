"""Hourly gzip JSON-lines event files: scan, split off bad lines, flatten, and write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import utc_date, utc_hour
from ..schemas import EVENT_LINE

#: Name of an hourly file, as the file itself or as the folder Spark wrote its parts into.
FILE_NAME = r"(\d{4}-\d{2}-\d{2}-\d{1,2}\.json\.gz)"


def file_name() -> Column:
    """The hourly name if the path has one, else the path's last element."""
    path = F.col("_metadata.file_path")
    hourly = F.regexp_extract(path, FILE_NAME, 1)
    return F.when(hourly != "", hourly).otherwise(F.substring_index(path, "/", -1)).alias("source_file")


def scan_event_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Every line of the files, blank ones too, as (value, source_file)."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .text(paths if isinstance(paths, str) else list(paths))
        .select("value", file_name())
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add the parsed ``event`` struct and the ``reject_reason``, NULL for loadable lines.

    ``malformed``: not a JSON object (blank lines included), more than one, anything after it, or a field
    of a wrong type.  ``incomplete``: JSON without an id, a type or a created_at.  Times without a zone
    are UTC.

    A JSON parser stops after the first value, so a line is parsed as the first element of a list whose second and last
    one holds a hash of the line: no text after the value can stand in for it, or add an element or a field, without
    the list being longer, broken or without the hash.  The struct is exploded from a one-element array: filters on a
    plain column would be pushed below it with a copy of the parse for every mention, so each line would be parsed
    several times.
    """
    mark = F.xxhash64("value").cast("string")
    whole = F.concat(F.lit('{"__line":['), "value", F.lit(',{"__end":"'), mark, F.lit('"}]}'))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt", "timeZone": "UTC"}
    parsed = lines.select("*", F.explode(F.array(F.from_json(whole, EVENT_LINE, options))).alias("__parsed"))
    elements = F.col("__parsed.__line")
    event = F.get(elements, F.lit(0)).dropFields("__end")
    alone = (F.size(elements) == 2) & (F.get(elements, F.lit(1))["__end"] == mark)
    malformed = (
        F.col("value").isNull()
        | ~F.ltrim("value").startswith("{")
        | event.isNull()
        | ~F.coalesce(alone, F.lit(False))
        | F.col("__parsed.__corrupt").isNotNull()
    )
    incomplete = event["id"].isNull() | event["type"].isNull() | event["created_at"].isNull()
    reason = F.when(malformed, "malformed").when(incomplete, "incomplete")
    return parsed.select(*[F.col(c) for c in lines.columns], event.alias("event"), reason.alias("reject_reason"))


def reject_bad_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split lines into (loadable, quarantine); each side is planned and pruned on its own."""
    parsed = parse_lines(lines)
    good = parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = parsed.filter(F.col("reject_reason").isNotNull()).select("source_file", "value", "reject_reason")
    return good, bad


def flatten_events(parsed: DataFrame, *extra: Column) -> DataFrame:
    """Nested event -> the 13 flat columns: repo id 0 becomes NULL, ``public`` defaults to true and
    ``payload`` to ``{}``.  ``extra`` columns follow."""
    e = F.col("event")
    repo_id = e["repo"]["id"]
    return parsed.select(
        e["id"].alias("event_id"),
        e["type"].alias("event_type"),
        e["created_at"].alias("created_at"),
        utc_date(e["created_at"]).alias("event_date"),
        e["actor"]["id"].alias("actor_id"),
        e["actor"]["login"].alias("actor_login"),
        F.when(~repo_id.isin("0", ""), repo_id).alias("repo_id"),
        e["repo"]["name"].alias("repo_name"),
        e["org"]["id"].alias("org_id"),
        e["org"]["login"].alias("org_login"),
        F.coalesce(e["public"], F.lit(True)).alias("is_public"),
        F.coalesce(e["payload"], F.lit("{}")).alias("payload"),
        F.col("source_file"),
        *extra,
    )


def _utc_text(instant: str) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.SSSSSSZ``."""
    second, micro = F.unix_seconds(instant), F.pmod(F.unix_micros(F.col(instant)), F.lit(1_000_000))
    minute = F.pmod(F.floor(second / 60), F.lit(60))
    clock = (utc_date(instant).cast("string"), utc_hour(instant), minute, F.pmod(second, F.lit(60)), micro)
    return F.format_string("%sT%02d:%02d:%02d.%06dZ", *clock)


def event_struct() -> Column:
    """The nested JSON shape of one flat raw row; numeric ids are written as JSON numbers."""
    number = lambda name: F.col(name).try_cast("bigint")
    org = F.struct(number("org_id").alias("id"), F.col("org_login").alias("login"))
    return F.struct(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("type"),
        F.struct(number("actor_id").alias("id"), F.col("actor_login").alias("login")).alias("actor"),
        F.struct(number("repo_id").alias("id"), F.col("repo_name").alias("name")).alias("repo"),
        F.when(F.col("org_id").isNotNull(), org).alias("org"),
        # of what is no JSON to Spark (a key that repeats, say) the text
        F.coalesce(F.try_parse_json("payload"), F.col("payload").cast("variant")).alias("payload"),
        F.col("is_public").alias("public"),
        _utc_text("created_at").alias("created_at"),
    )


def event_lines(raw: DataFrame) -> DataFrame:
    """Raw rows back as (value, source_file) lines."""
    return raw.select(F.to_json(event_struct()).alias("value"), "source_file")


def write_event_files(raw: DataFrame, path: str) -> str:
    """Write raw rows as gzip JSON lines, one folder per hourly file name."""
    (
        event_lines(raw)
        .hint("rebalance", "source_file")
        .write.partitionBy("source_file")
        .option("compression", "gzip")
        .text(path)
    )
    return path
