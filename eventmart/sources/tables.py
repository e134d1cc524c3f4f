"""Table sinks: full refresh, date-partitioned, and clustered layouts.

Rows that come out of a shuffle are written through ``REBALANCE(event_date)``: adaptive execution
cuts an oversized date into several tasks and packs small dates together, so a date that holds a
third of all rows is not one task, and small dates do not leave one file per task.  Rows that come
straight from a date-partitioned scan are already grouped by date and are written as they are.

Nothing is deleted before what replaces it is there: new files are written into a hidden folder of the table, a record
of the files they replace is put beside them, and only then are they moved in and the old ones deleted.  The record
decides: before it the table is the old one, after it whoever reads or writes the table next finishes the switch first.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

PARTITION = "event_date"
CLUSTERING = ["event_type", "repo_id", "actor_id"]
LAYERS = ["raw", "staging", "marts", "seeds", "snapshots", "test_results"]


def write_by_date(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    cluster_by: Sequence[str] = (),
    rebalance: bool = True,
) -> None:
    """Write partitioned by event_date.

    ``mode``: ``overwrite`` replaces the table, ``replace_dates`` only the dates present in ``df``
    (which may be computed from the table itself), ``append`` adds files.
    ``rebalance=False`` is for row-wise results over a date-partitioned table: no shuffle at all.
    """
    shaped = df.hint("rebalance", PARTITION) if rebalance else df
    if cluster_by:
        shaped = shaped.sortWithinPartitions(PARTITION, *cluster_by)
    if mode == "append":
        finish_replacement(df.sparkSession, path)
        shaped.write.partitionBy(PARTITION).mode("append").parquet(path)
    elif mode in ("overwrite", "replace_dates"):
        replace_files(shaped, path, None, mode == "replace_dates", PARTITION)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    _keep_schema(df, path)


_NEW, _RECORD = "_new-", "_replace-"


def _files(spark: SparkSession, path: str):
    """File system of a path, and the path as its class."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _data_files(files, folder) -> list[str]:
    """Files below a folder that readers see."""
    found, open_ = [], [folder]
    while open_:
        at = open_.pop()
        for status in files.listStatus(at) if files.exists(at) else []:
            name = status.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if status.isDirectory():
                open_.append(status.getPath())
            else:
                found.append(status.getPath().toString())
    return found


def _write_text(files, target, text: str) -> None:
    out = files.create(target, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def _read_text(spark: SparkSession, files, target) -> str:
    stream = files.open(target)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def replace_files(df: DataFrame, path: str, old: Sequence[str] | None, own_dates: bool = False, partition: str | None = None) -> None:
    """Write ``df`` as files that take the place of the files ``old``: of all of the table if None, or of those of the
    dates that ``df`` has with ``own_dates``.  ``df`` may be computed from them.  One writer at a time."""
    spark, label = df.sparkSession, uuid.uuid4().hex
    finish_replacement(spark, path)
    files, root = _files(spark, path)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    for status in files.listStatus(root) if files.exists(root) else []:
        if status.getPath().getName().startswith(_NEW):  # of a writer that broke off before its record
            files.delete(status.getPath(), True)
    new = path_of(root, f"{_NEW}{label}")
    writer = df.write.partitionBy(partition) if partition else df.write
    writer.parquet(new.toString())
    if own_dates:
        folders = [s.getPath().getName() for s in files.listStatus(new) if s.isDirectory()]
        old = [f for name in folders for f in _data_files(files, path_of(root, name))]
    elif old is None:
        old = _data_files(files, root)
    draft = path_of(root, f"{_NEW}{label}.json")
    _write_text(files, draft, json.dumps({"new": new.toString(), "old": list(old)}))
    files.rename(draft, path_of(root, f"{_RECORD}{label}.json"))
    finish_replacement(spark, path)


def replace_partition(df: DataFrame, path: str, partition: str, value: str) -> None:
    """Write ``df`` partitioned by a column: its rows take the place of the partition ``value`` and are added to the
    others, by one switch.  ``df`` may be computed from the table."""
    spark = df.sparkSession
    finish_replacement(spark, path)
    files, folder = _files(spark, f"{path}/{partition}={value}")
    replace_files(df, path, _data_files(files, folder), partition=partition)
    _keep_schema(df, path)


def finish_replacement(spark: SparkSession, path: str) -> None:
    """Finish the switch of every record there is.  Each step can be done again, by several at once too."""
    files, root = _files(spark, path)
    if not files.exists(root):
        return
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    for status in files.listStatus(root):
        record = status.getPath()
        if not record.getName().startswith(_RECORD):
            continue
        plan = json.loads(_read_text(spark, files, record))
        new = path_of(plan["new"])
        for file in _data_files(files, new):
            folder = path_of(file).getParent()
            target = root if folder.getName() == new.getName() else path_of(root, folder.getName())
            files.mkdirs(target)
            files.rename(path_of(file), path_of(target, path_of(file).getName()))
        folders = set()
        for file in plan["old"]:
            files.delete(path_of(file), False)
            folders.add(path_of(file).getParent().toString())
        for folder in folders - {root.toString()}:
            left = path_of(folder)
            if left.getName() != root.getName() and files.exists(left) and not _data_files(files, left):
                files.delete(left, True)
        files.create(path_of(root, "_SUCCESS"), True).close()
        files.delete(new, True)
        files.delete(record, False)


def _schema_file(spark: SparkSession, path: str):
    return _files(spark, f"{path}/_schema.json")


def _keep_schema(df: DataFrame, path: str) -> None:
    """Beside the data, since a date-partitioned table without rows has no file to infer it from."""
    fields = sorted(df.schema.fields, key=lambda f: f.name == PARTITION)  # as the table is read: dates last
    files, target = _schema_file(df.sparkSession, path)
    _write_text(files, target, StructType(fields).json())


def read_by_date(spark: SparkSession, path: str) -> DataFrame:
    """Scan of a table, with the schema it was written with if that is known."""
    finish_replacement(spark, path)
    files, target = _schema_file(spark, path)
    if not files.exists(target):
        return spark.read.parquet(path)
    schema = StructType.fromJson(json.loads(_read_text(spark, files, target)))
    return spark.read.schema(schema).parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Full refresh of an unpartitioned table; adaptive execution already sizes its tasks."""
    replace_files(df, path, None)


def write_clustered(df: DataFrame, path: str, mode: str = "overwrite", rebalance: bool = True) -> None:
    """The fact layout: one folder per date, rows sorted so row-group statistics skip event types,
    repositories and actors."""
    write_by_date(df, path, mode, CLUSTERING, rebalance)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def date_folders(spark: SparkSession, path: str) -> dict[dt.date, str]:
    """The table's date folders by date, from one directory listing."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    listing = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    found = {}
    for status in listing:
        name = status.getPath().getName()
        if name.startswith(f"{PARTITION}=") and not name.endswith("__HIVE_DEFAULT_PARTITION__"):
            found[dt.date.fromisoformat(name.partition("=")[2])] = status.getPath().toString()
    return found


class Warehouse:
    """Tables of the five layers under one root folder, optionally visible to ``spark.sql``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        layer, name = table.split(".")
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root}/{layer}/{name}"

    def exists(self, table: str) -> bool:
        return path_exists(self.spark, self.path(table))

    def read(self, table: str) -> DataFrame:
        return read_by_date(self.spark, self.path(table))

    def newest_date(self, table: str) -> dt.date | None:
        """The newest date of a date-partitioned table, without reading its files."""
        return max(date_folders(self.spark, self.path(table)), default=None)

    def register(self, table: str) -> None:
        """Make the table queryable as ``layer.name``; folders and files stay where they are."""
        layer, name = table.split(".")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        self.spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
        self.spark.catalog.createTable(f"{layer}.{name}", path=self.path(table), source="parquet")
        if PARTITION in self.spark.table(f"{layer}.{name}").columns and self._partitioned(table):
            self.spark.catalog.recoverPartitions(f"{layer}.{name}")

    def _partitioned(self, table: str) -> bool:
        layer, name = table.split(".")
        return any(c.isPartition for c in self.spark.catalog.listColumns(f"{layer}.{name}"))
