"""Spark result against DuckDB result, order-insensitive, as the driver does it."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"create view {name} as select * from read_parquet('{path if os.path.isfile(path) else path + '/*.parquet'}')")
    return con


def norm(v):
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.15g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(norm(x) for x in v.values())
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(tuple(norm(r[k]) for k in order) for r in data)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want, got = rows(names, cur.fetchall()), rows(df.columns, df.collect())
    if want != got:
        return f"{sum(got.values())} rows against {sum(want.values())}; only Spark {list((got - want).items())[:3]}; only DuckDB {list((want - got).items())[:3]}"
    return None
