"""Strict comparison of a Spark result with its SQL statement on DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        # Same scale on both sides: 1.10 and 1.1 do not count as equal.
        return format(v, "f")
    return repr(v) if isinstance(v, float) else str(v) if v is not None else None


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_cell(r[i]) or "~" for i in order) for r in data)


def compare(df, con, sql) -> str:
    """Empty text when equal, else what differs."""
    names, got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    exp_names, exp = rows([c[0] for c in cur.description], cur.fetchall())
    if names != exp_names:
        return f"columns {names} != {exp_names}"
    if len(got) != len(exp):
        return f"rows {len(got)} != {len(exp)}"
    for a, b in zip(got, exp):
        if a != b:
            diff = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
            return f"row differs: {diff[:4]} in {a[:6]}"
    return ""
