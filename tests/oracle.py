"""Spark's rows against DuckDB's, names and order aside."""

from __future__ import annotations

import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in os.listdir(folder):
        path = f"{folder}/{name}"
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def rows(columns: list[str], data: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda v: repr(round(v, 9) + 0.0) if isinstance(v, float) else str(v)
    return sorted(tuple(show(r[i]) for i in order) for r in data)


def same(df, sql: str, folder: str) -> None:
    got = connect(folder).execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, got.fetchall())
