"""Rows of a query against rows of its SQL."""

from __future__ import annotations

import os

import duckdb


def plain(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, list | tuple):
        return str([plain(x) for x in v])
    return str(v)


def rows(names: list[str], values) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(r[i]) for i in order) for r in values)


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for f in os.listdir(sf_dir):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf_dir}/{f}'")
    return c


def same(spark, sf_dir: str, query, sql: str) -> None:
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    found = tables(sf_dir).sql(sql)
    assert sorted(df.columns) == sorted(found.columns)
    assert got == rows(found.columns, found.fetchall())
