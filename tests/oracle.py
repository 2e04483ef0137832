"""Comparing a query's rows with those of its SQL in DuckDB, as multisets, columns by name."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    if isinstance(x, (bool, str)):
        return x
    if isinstance(x, (int, float)) or hasattr(x, "as_tuple"):
        return round(float(x), 9)
    return x


def rows(columns: list[str], values: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=repr)


def assert_same(df, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    relation = con.sql(sql)
    assert sorted(df.columns) == sorted(relation.columns)
    assert rows(df.columns, df.collect()) == rows(relation.columns, relation.fetchall())
