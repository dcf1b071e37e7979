"""Runs a query and its SQL side by side."""

import math

import duckdb

from loomspark.session import TABLES


def connection(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in data)


def same(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    found = con.sql(sql)
    assert sorted(df.columns) == sorted(found.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(found.columns, found.fetchall())
