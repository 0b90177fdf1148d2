"""Compare a query with its SQL on the other engine: row count, columns, order-free values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def same(left, right) -> bool:
    if len(left) != len(right):
        return False
    return all(
        a == b or (type(a) is type(b) is float and math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12))
        for row, other in zip(left, right)
        for a, b in zip(row, other)
    )


def compare(df, sql: str, connection) -> str:
    """``same (n rows)`` when both agree, otherwise what differs."""
    mine = [tuple(row) for row in df.collect()]
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = rows_of(df.columns, mine), rows_of(names, theirs)
    if same(a, b):
        return f"same ({len(a)} rows)"
    odd = next(((x, y) for x, y in zip(a, b) if x != y), None)
    return f"{len(a)} vs {len(b)} rows; first difference {odd}"
