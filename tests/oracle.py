"""Strict comparison of a Spark result with its DuckDB twin."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads=4")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, str):
        return "str"
    return type(value).__name__


def cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (list, tuple)):
        return tuple(cell(v) for v in value)
    if isinstance(value, (datetime.date, datetime.datetime, decimal.Decimal)):
        return str(value)
    return value


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(cell(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(table, key=repr)


def differences(df, con, query: str) -> str | None:
    """None if equal, else a short text. Types count: 1 and 1.0 differ."""
    mine = df.collect()
    names, left = normal(df.columns, [tuple(row) for row in mine])
    result = con.execute(query)
    other, right = normal([d[0] for d in result.description], result.fetchall())
    if names != other:
        return f"columns {names} != {other}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    if repr(left) != repr(right):
        pairs = [(a, b) for a, b in zip(left, right) if repr(a) != repr(b)]
        return f"{len(pairs)} of {len(left)} rows differ, first {pairs[0]}"
    return None
