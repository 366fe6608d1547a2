"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


def differences(frame, connection, sql, limit=3):
    """Empty when both sides give the same columns and the same rows."""
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    expected = _rows(columns, result.fetchall())
    actual = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    if sorted(columns) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} <> {sorted(columns)}"]
    if len(actual) != len(expected):
        return [f"{len(actual)} rows <> {len(expected)}"] + [
            repr(r) for r in list(set(actual) ^ set(expected))[:limit]]
    return [f"{a} <> {e}" for a, e in zip(actual, expected) if repr(a) != repr(e)][:limit]
