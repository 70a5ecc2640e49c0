"""Runs registered queries next to their SQL twins in DuckDB and compares values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, f"{v:.9g}")
    if isinstance(v, bool):
        return (2, str(v))
    return (3, str(v))


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in data)


def exact(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple((0, "") if r[i] is None else (1, repr(r[i])) for i in order) for r in data)


def types(columns, kinds):
    return dict(zip(columns, kinds))
