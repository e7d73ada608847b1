"""Compares a query with its SQL in DuckDB, on the same parquet tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p if p.is_file() else str(p) + '/*.parquet'}')")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    if type(x).__name__ == "Row":
        return tuple(plain(y) for y in x)
    if isinstance(x, dict):
        return tuple(plain(y) for y in x.values())
    return x


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in data), key=repr)


def same(spark, sf_dir: str, query, sql: str) -> int:
    df = query(spark, sf_dir)
    ours = rows(df.columns, df.collect())
    con = connect(sf_dir)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = rows(names, cur.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert len(ours) == len(theirs), (len(ours), len(theirs))
    for a, b in zip(ours, theirs, strict=True):
        assert a == b, (a, b)
    return len(ours)
