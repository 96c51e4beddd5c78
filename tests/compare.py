"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import glob
import math
import os
from decimal import Decimal

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return str(value)
    return value if value is None or isinstance(value, bool) else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_value(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(shaped, key=repr)


def differences(df, connection, sql: str) -> str | None:
    """None if columns and rows agree exactly, else what differs first."""
    names, ours = _rows(df.columns, [tuple(row) for row in df.collect()])
    cursor = connection.execute(sql)
    oracle_names, theirs = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if names != oracle_names:
        return f"columns {names} / {oracle_names}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} of {len(ours)} rows, first {wrong[0]}" if wrong else None
