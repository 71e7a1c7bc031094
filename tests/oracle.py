"""Runs a registered query and its SQL on the same files and compares the rows."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import duckdb

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "array<string>": "VARCHAR[]",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), v if not isinstance(v, (list, dt.date)) else str(v)) for v in row)


def compare(spark, sf_dir: str, query, sql: str, con=None) -> str | None:
    """None if schema and rows agree, otherwise what differs."""
    con = con or connect(sf_dir)
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    rel = con.sql(sql)
    expected_types = dict(zip(rel.columns, map(str, rel.types)))
    if names != sorted(rel.columns):
        return f"columns {names} vs {sorted(rel.columns)}"
    found_types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    if found_types != {n: expected_types[n] for n in found_types}:
        return f"types {found_types} vs {expected_types}"
    found = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_key)
    at = [rel.columns.index(n) for n in names]
    expected = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=_key)
    if len(found) != len(expected):
        return f"{len(found)} rows vs {len(expected)}"
    wrong = [(a, b) for a, b in zip(found, expected) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(found)} rows differ, e.g. {names}: {wrong[0][0]} vs {wrong[0][1]}"
    return None if found else "no rows"
