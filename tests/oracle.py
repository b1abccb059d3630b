"""Runs queries and their SQL on the same tables and compares rows: columns by name, rows in any order."""

from __future__ import annotations

import decimal
import math

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(x: object) -> object:
    if x is None or (isinstance(x, float) and math.isnan(x)) or x is pd.NaT:
        return None
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return round(x, 4) + 0.0
    if hasattr(x, "item"):
        return plain(x.item())
    return x


def rows(names: list[str], data: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[k]) for k in order) for r in data), key=repr)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:  # noqa: ANN001
    """'' if both give the same rows, else what differs first."""
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(got) != len(want):
        extra = next((x for x in got if x not in want[:5000]), None) if len(got) < 5000 else None
        return f"{len(got)} and {len(want)} rows; {extra}"
    return next((f"{a} and {b}" for a, b in zip(got, want, strict=True) if a != b), "")
