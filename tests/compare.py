"""Compares a Spark result with a DuckDB result, value by value and regardless of row order."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _kind(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return f"b{v}"
    if isinstance(v, int):
        return f"i{v}"
    if isinstance(v, float):
        return f"f{v + 0.0!r}"
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_kind(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, x or "") for x in r))


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return _rows(columns, cur.fetchall())


def difference(df, con, sql) -> str | None:
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    if sc != dc:
        return f"columns {sc} != {dc}"
    if len(sr) != len(dr):
        return f"rows {len(sr)} != {len(dr)}; first {sr[:2]} / {dr[:2]}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    if bad:
        return f"{len(bad)} of {len(sr)} rows differ on {sc}; e.g. {bad[0][0]} / {bad[0][1]}"
    return None
