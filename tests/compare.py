"""Runs a query and its SQL side by side."""

from __future__ import annotations

import glob
import math
import os
from decimal import Decimal

import duckdb

DATA = "/root/testdata"


def connection(sf_dir: str):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(f).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{f}{'/*.parquet' if os.path.isdir(f) else ''}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, Decimal):
        return round(float(v), 9)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v if v is None or isinstance(v, (int, str, bool, bytes)) else str(v)


def rows_of(names, rows):
    order = [names.index(n) for n in sorted(names)]
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def same(spark, query, sql: str, sf_dir: str) -> int:
    """Asserts equal columns and rows; the number of rows."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    done = connection(sf_dir).execute(sql)
    names = [d[0] for d in done.description]
    assert sorted(df.columns) == sorted(names)
    assert got == rows_of(names, done.fetchall())
    return len(got)
