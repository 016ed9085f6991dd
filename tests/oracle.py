"""Compare registered queries with their SQL answers."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{root}/{name}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, (str, bool)):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0
    if isinstance(v, int):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(df, con, sql):
    """None if both give the same columns and values, else a description of the difference."""
    mine = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(want):
        return f"{len(mine)} rows, expected {len(want)}; first {mine[:2]} / {want[:2]}"
    for a, b in zip(mine, want):
        if a != b:
            return f"{a}\n   != {b}"
    return None if mine else "no rows"
