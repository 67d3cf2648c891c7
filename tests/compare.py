"""Runs registered queries and their SQL side by side."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, bool) or v is None:
        return str(v)
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else v.isoformat()
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in data)


def compare(spark, con, function, sql: str, sf_dir: str):
    """None when equal, else a short account of the difference."""
    df = function(spark, sf_dir)
    got = rows(df.columns, df.collect())
    rel = con.execute(sql)
    columns = [d[0] for d in rel.description]
    want = rows(columns, rel.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        pairs = [(g, w) for g, w in zip(got, want) if g != w][:3]
        return f"{len(got)} rows, expected {len(want)}; columns {sorted(columns)}; first differences {pairs}"
    return None
