"""Spark results against DuckDB's on the same files."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def _value(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    return f"{x:.6g}" if isinstance(x, float) else x


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in data), key=repr)


def same(df, sql, sf_dir):
    result = duck(sf_dir).sql(sql)
    assert sorted(df.columns) == sorted(result.columns)
    got, want = rows(df.columns, [tuple(r) for r in df.collect()]), rows(result.columns, result.fetchall())
    assert got == want
