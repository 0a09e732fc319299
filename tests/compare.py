"""Run a registered query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(picked, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def differences(spark, sf_dir: str, query, sql: str) -> list[str]:
    """What differs between the two engines; empty if nothing does."""
    found = query(spark, sf_dir)
    result = duck(sf_dir).execute(sql)
    names = [d[0] for d in result.description]
    if sorted(found.columns) != sorted(names):
        return [f"columns {sorted(found.columns)} != {sorted(names)}"]
    ours = _sorted_rows(found.columns, found.collect())
    theirs = _sorted_rows(names, result.fetchall())
    out = []
    if len(ours) != len(theirs):
        out.append(f"row counts {len(ours)} != {len(theirs)}")
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            out.append(f"{a} != {b}")
            break
    return out
