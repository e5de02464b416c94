"""Holds a query's rows against DuckDB's for its SQL, columns by name, rows in any order."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.sql(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    got = con.sql(sql)
    return got.columns, got.fetchall()


def same(df, sql: str, sf_dir: str) -> None:
    columns, rows = oracle_rows(sql, sf_dir)
    order = sorted(df.columns)
    assert order == sorted(columns)
    found = sorted(repr([plain(r[c]) for c in order]) for r in df.collect())
    wanted = sorted(repr([plain(r[columns.index(c)]) for c in order]) for r in rows)
    assert found == wanted
