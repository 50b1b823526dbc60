"""Comparison of query results with the same SQL run by DuckDB."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """A connection with one view per table."""
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{folder}/{table}.parquet").exists():
            connection.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, int):
        return str(value)
    return "\0" if value is None else str(value)


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Rows in a fixed order, columns by name."""
    order = sorted(range(len(columns)), key=lambda place: columns[place])
    return sorted(columns), sorted(tuple(_plain(row[place]) for place in order) for row in rows)


def compare(spark, folder: str, make, sql: str, connection=None) -> str | None:
    """None if equal, else what differs."""
    frame = make(spark, folder)
    left = canonical(frame.columns, frame.collect())
    cursor = (connection or connect(folder)).execute(sql)
    right = canonical([column[0] for column in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} against {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows against {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1], strict=True) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
