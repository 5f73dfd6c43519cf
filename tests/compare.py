"""Comparing a Spark result with DuckDB's over the same tables."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else format(v, ".9g")
        return v

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def differences(frame, connection, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    mine = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = canonical(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} / {sorted(names)}"
    if mine == theirs:
        return None
    extra, lacking = [r for r in mine if r not in set(theirs)][:3], [r for r in theirs if r not in set(mine)][:3]
    return f"rows {len(mine)} / {len(theirs)}; only here {extra}; only there {lacking}"
