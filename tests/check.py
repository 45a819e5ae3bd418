"""Compare Spark results with DuckDB over the same tables, cell by cell."""

from __future__ import annotations

import datetime
import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _kind(value):
    return {bool: "boolean", int: "integer", float: "double", str: "text"}.get(type(value), type(value).__name__)


def _sortable(row):
    return tuple((value is not None, str(type(value)), value if value is not None else 0) for value in row)


def _plain(value):
    return value.replace(microsecond=0) if isinstance(value, datetime.datetime) and not value.microsecond else value


def difference(df, connection, sql: str) -> str | None:
    """First difference between a Spark result and a SQL result, or None."""
    names = sorted(df.columns)
    cursor = connection.execute(sql)
    sql_names = [d[0] for d in cursor.description]
    if sorted(sql_names) != names:
        return f"columns {names} != {sorted(sql_names)}"
    places = [sql_names.index(n) for n in names]
    expected = sorted(([tuple(_plain(row[i]) for i in places) for row in cursor.fetchall()]), key=_sortable)
    actual = sorted(([tuple(_plain(row[n]) for n in names) for row in df.collect()]), key=_sortable)
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    for left, right in zip(actual, expected):
        for name, a, b in zip(names, left, right):
            if _kind(a) != _kind(b) or a != b:
                return f"{name}: {a!r} != {b!r} in {left} / {right}"
    return None
