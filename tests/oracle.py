"""Shared compare helper: Spark result vs DuckDB oracle on the same Parquet tables."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of_spark(df):
    cols = df.columns
    return cols, [tuple(norm(r[c]) for c in cols) for r in df.collect()]


def rows_of_sql(con, sql, cols):
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    data = cur.fetchall()
    assert sorted(dcols) == sorted(cols), (sorted(dcols), sorted(cols))
    idx = [dcols.index(c) for c in cols]
    return [tuple(norm(r[i]) for i in idx) for r in data]


def canon(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))
