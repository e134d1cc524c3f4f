"""Run an oracle in DuckDB and compare it with a Spark result, ignoring row order."""

from __future__ import annotations

import datetime as dt
import decimal
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def plain(value):
    """One comparable form per value; type differences that matter stay visible."""
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, dt.datetime):
        return ("timestamp", value.replace(tzinfo=None).isoformat())
    return (type(value).__name__, str(value))


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(plain(r[i]) for i in order) for r in rows])


def spark_table(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def duck_table(con, text):
    found = con.execute(text)
    return table([c[0] for c in found.description], found.fetchall())
