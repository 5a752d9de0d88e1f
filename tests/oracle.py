"""Compares every query with its SQL in DuckDB, sorted rows and exact values."""

from __future__ import annotations

import glob
import os

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sorted(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when both sides hold the same rows under the same column names."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected = _sorted(names, found.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    actual = _sorted(df.columns, [tuple(r) for r in df.collect()])
    notes = []
    if len(actual) != len(expected):
        notes.append(f"{len(actual)} rows != {len(expected)}")
    notes += [f"{a} != {e}" for a, e in zip(actual, expected) if a != e][:3]
    if not expected:
        notes.append("no rows expected: the query proves nothing")
    return notes
