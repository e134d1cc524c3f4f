"""Helpers shared by the operators: table access, staged tables, text as words, joins on hot keys."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import new_folder
from ..sources.tables import delete_folder

#: Words of every contract that says "words": runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Spark drops the shuffle files of a query as soon as it has ended; the written table replaces them.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows of an Arrow batch.
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Texts, and rows of a few numbers, of a batch.  Spark's 10,000 texts are some 35 MB, which the JVM and each Python
#: worker hold several times over.
TEXT_ROWS, NUMBER_ROWS = 512, 10_000


def text_batches(spark: SparkSession) -> None:
    """From now on at most TEXT_ROWS rows at a time go to Python in this session, if nothing else is said."""
    if not 0 < int(spark.conf.get(_ARROW_ROWS)) <= TEXT_ROWS:
        spark.conf.set(_ARROW_ROWS, str(TEXT_ROWS))


def stage(df: DataFrame, label: str, drop: tuple[DataFrame, ...] = (), batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and scan it from there: cuts lineage, survives lost executors.

    ``drop``: staged tables that nothing reads any more once this one is written.  ``batch_rows``: rows of its
    Arrow batches.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    own = {_CLEANUP: "true"} | ({_ARROW_ROWS: str(batch_rows)} if batch_rows else {})
    before = {key: spark.conf.get(key, None) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    for old in drop:
        delete_folder(spark, old.staged_path)
    found = spark.read.schema(df.schema).parquet(path)
    found.staged_path = path
    return found


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding it."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def text_key() -> Column:
    """With doc_id, tells rows apart: rows alike in both are the same document."""
    return F.xxhash64("text")


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], spread: Column, how: str = "left", ways: int = 16):
    """Join a side with hot keys to one with a row per key; a hot key's rows go to ``ways`` tasks."""
    left = big.withColumn("__salt", F.pmod(spread, F.lit(ways)).cast("int"))
    right = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
    return left.join(right, [*keys, "__salt"], how).drop("__salt")


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast an object of this package; call the result in a task to get it."""
    sent, opened = spark.sparkContext.broadcast(cloudpickle.dumps(value)), []

    def get() -> Any:
        if not opened:
            opened.append(pickle.loads(sent.value))
        return opened[0]

    return get
