"""Runs a query and its SQL on the same tables and compares all rows."""

import datetime as dt
import os

import duckdb

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connect(folder=DATA):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(folder):
        p = f"{folder}/{f}" + ("/*.parquet" if os.path.isdir(f"{folder}/{f}") else "")
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{p}')")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def same(spark, name, f, sql, folder=DATA):
    df = f(spark, folder)
    got = connect(folder).execute(sql)
    columns = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(columns), name
    assert rows(df.columns, df.collect()) == rows(columns, got.fetchall()), name
