"""Distinct counts of any range of days, from one set of bitmaps per day.

Distinct counts of several days are not the sum of the days' counts.  Entities get dense numbers once, in an append-only
table; a day then stores, per event type and kind of account, which numbers it has seen, as bitmaps of 32,768 numbers
each (a page).  Pages of several days merge by OR, so the distinct entities of a week, a month or any other range, by
event type, by kind of account or over all, come from the days' bitmaps: no event is read, and what is shuffled (and
sorted, as Spark merges binary values that way) are pages, not entities.
A bitmap takes 4 KB before compression however few of its bits are set; runs of zeros compress well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import staged

#: Kinds of entities and their columns in the activity days (or the events).
KINDS = {"actor": "actor_id", "repository": "repo_id", "organization": "org_id"}
#: Names of the counts.
MEASURES = {"actor": "unique_actors", "repository": "unique_repositories", "organization": "unique_organizations"}
GROUP = ["event_type", "is_bot"]
NUMBERS = "kind string, entity_id string, number long"
#: New entities that one task numbers, on average.
_PER_TASK = 1 << 20


def _entities(days: DataFrame, *keys: str) -> DataFrame:
    """Distinct ``*keys, kind, entity_id``; a NULL id is no entity."""
    each = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(column).alias("entity_id")) for kind, column in KINDS.items()])
    return days.select(*keys, F.inline(each)).filter("entity_id is not null").distinct()


def number_new(new: DataFrame, taken: dict[str, int]) -> DataFrame:
    """Numbers for the staged ``kind, entity_id`` rows of ``new``, per kind without gaps from ``taken`` + 1 on.

    Entities are dealt to slots by hash and ranked within them; the slots' sizes (a row per million new entities and
    kind) give each slot its first number, so no task sees all of a kind.
    """
    slots = max(1, new.count() // _PER_TASK)
    dealt = new.withColumn("slot", F.pmod(F.xxhash64("entity_id"), F.lit(slots)))
    sizes = dealt.groupBy("kind", "slot").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("kind").orderBy("slot").rowsBetween(W.unboundedPreceding, -1))
    first = sizes.select("kind", "slot", F.coalesce(before, F.lit(0)).alias("first"))
    rank = F.row_number().over(W.partitionBy("kind", "slot").orderBy("entity_id"))
    highest = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in taken.items() for x in pair]), F.col("kind")), F.lit(0)) if taken else F.lit(0)
    numbered = dealt.withColumn("rank", rank).join(F.broadcast(first), ["kind", "slot"])
    return numbered.select("kind", "entity_id", (highest + F.col("first") + F.col("rank")).cast("long").alias("number"))


def add_numbers(spark: SparkSession, days: DataFrame, path: str) -> DataFrame:
    """Append numbers for the entities of ``days`` that have none yet; returns the whole table of numbers.

    Numbers never change.  A broken append leaves some entities numbered and the rest to the next call.  One writer
    at a time.
    """
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)
    known = spark.read.schema(NUMBERS).parquet(path) if exists else spark.createDataFrame([], NUMBERS)
    taken = {r["kind"]: r["n"] for r in known.groupBy("kind").agg(F.max("number").alias("n")).collect()}
    with staged(_entities(days).join(known, ["kind", "entity_id"], "left_anti"), "entities") as new:
        number_new(new, taken).write.mode("append").parquet(path)
    return spark.read.schema(NUMBERS).parquet(path)


def daily_bitmaps(days: DataFrame, numbers: DataFrame) -> DataFrame:
    """``event_date, event_type, is_bot, kind, page, bitmap`` of activity days (or events); a page without entities has
    no row.  Rows of one date depend on that date alone."""
    seen = _entities(days, "event_date", *GROUP).join(numbers, ["kind", "entity_id"])
    page = F.bitmap_bucket_number("number").alias("page")
    return seen.groupBy("event_date", *GROUP, "kind", page).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
    )


def distinct_counts(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact distinct actors, repositories and organizations of all rows given, per ``by`` (of event_date, event_type and
    is_bot).  Filter by event_date first: that prunes date folders."""
    pages = bitmaps.groupBy(*by, "kind", "page").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    counts = [F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).alias(name) for kind, name in MEASURES.items()]
    return pages.groupBy(*by).agg(*counts)
