"""Order-insensitive comparison of a Spark result with DuckDB's."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        path = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def plain(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "~" if math.isnan(value) else f"{value + 0.0:.9g}"
    return str(value) if not isinstance(value, int) else f"{float(value):.9g}"


def same(df, con, sql):
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    theirs = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert sorted(names) == columns
    assert ours == theirs
