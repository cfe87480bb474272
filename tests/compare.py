"""Compare a named query with its SQL in DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str):
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def sql_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    return _sorted_columns(names, cursor.fetchall())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return _sorted_columns(df.columns, [tuple(row) for row in df.collect()])


def _sorted_columns(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    shaped = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(shaped, key=repr)


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def difference(left, right) -> str | None:
    """None when equal, else a short description."""
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])}"
    different = [(a, b) for a, b in zip(left[1], right[1]) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    if different:
        return f"{len(different)} of {len(left[1])} rows, first {different[0]}"
    return None
