"""A query's rows and its SQL's rows, in a form that can be compared."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(f"{sf_dir}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p if p.is_file() else f'{p}/*.parquet'}'")
    return con


def _plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, bool) or x is None or isinstance(x, str):
        return x
    if isinstance(x, int):
        return float(x)
    return str(x)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


def compare(spark, sf_dir: str, f, sql: str) -> str:
    """Empty if both give the same rows, else what differs."""
    df = f(spark, sf_dir)
    got_c, got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = connect(sf_dir).execute(sql)
    want_c, want = rows([c[0] for c in cur.description], cur.fetchall())
    if got_c != want_c:
        return f"columns {got_c} != {want_c}"
    if got != want:
        a, b = [r for r in got if r not in set(want)], [r for r in want if r not in set(got)]
        return f"{len(got)} and {len(want)} rows; only here {a[:3]}; only there {b[:3]}"
    return ""
