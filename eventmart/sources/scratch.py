"""Shared working folder for intermediate tables.

A written table cuts lineage and, unlike executor-local blocks, is still there after an executor is
lost.  The folder is the one the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from .tables import delete_folder


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"eventmart-{application}-")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session may do without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder(spark.sparkContext.applicationId)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Write ``df`` once as parquet and give a scan of it, for inputs used more than once.

    The table is dropped at the end of the block, so results must be written inside it.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_folder(spark, path)
