"""Run a query and its SQL twin on the same tables and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _key(row: tuple) -> tuple:
    return tuple((v is None, type(v).__name__, v if v is not None else 0) for v in row)


def difference(df, connection: duckdb.DuckDBPyConnection, sql: str, digits: int = 9) -> str | None:
    """None when both sides agree, else the first disagreement."""
    columns = sorted(df.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=_key)
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_key)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for mine, other in zip(ours, theirs):
        for a, b in zip(mine, other):
            same = math.isclose(a, b, rel_tol=0, abs_tol=10**-digits) if isinstance(a, float) else a == b
            if type(a) is not type(b) or not same:
                return f"{mine} against {other}"
    return None
