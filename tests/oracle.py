"""Compares a query with its SQL in DuckDB: row count, columns and values in any order."""

import glob
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if hasattr(v, "as_tuple"):
        return round(float(v), 6)
    return v


def compare(spark, name, query, sql, sf_dir="/root/testdata/sf0.01"):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    want = con.execute(sql)
    cols = [d[0] for d in want.description]
    rows = want.fetchall()
    df = query(spark, sf_dir)
    assert sorted(df.columns) == sorted(cols), (name, df.columns, cols)
    order = sorted(cols)
    a = sorted((tuple(_norm(r[c]) for c in order) for r in df.collect()), key=repr)
    b = sorted((tuple(_norm(r[cols.index(c)]) for c in order) for r in rows), key=repr)
    assert len(a) == len(b), (name, len(a), len(b))
    for x, y in zip(a, b):
        assert x == y, (name, x, y)
    return len(a)
