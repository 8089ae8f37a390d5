"""Compares a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir, f"{name}.parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}{'/*.parquet' if path.is_dir() else ''}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    if hasattr(value, "item"):
        return plain(value.item())
    return value


def difference(df, con, sql: str) -> str:
    """Empty if both have the same columns and rows, whatever their order."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    order = sorted(names)
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in found.fetchall()), key=repr)
    ours = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows and {len(theirs)}"
    return next((f"{order}: {a} and {b}" for a, b in zip(ours, theirs) if a != b), "")
