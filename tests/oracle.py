"""Compare a registered query with its SQL, row by row."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return v + 0.0
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql) -> str:
    """An empty string when both give the same columns and rows."""
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    if sorted(df.columns) != sorted(want_names):
        return f"columns {sorted(df.columns)} != {sorted(want_names)}"
    want = _rows(want_names, cur.fetchall())
    got = _rows(df.columns, df.collect())
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    differing = [
        (g, w)
        for g, w in zip(got, want)
        if g != w or any(type(a) is not type(b) for a, b in zip(g, w))
    ]
    return f"{len(differing)} of {len(got)} rows differ, first {differing[0]}" if differing else ""
