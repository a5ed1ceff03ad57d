"""Compare a Spark query with its DuckDB oracle (rows, columns, values)."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

VIEWS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
         "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in VIEWS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(float(v))
    if isinstance(v, Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    body = sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple("" if x is None else x for x in t))
    return cols, body


def compare(spark_df, con, sql: str):
    """Return (ok, message)."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count differs: spark={len(sr)} duck={len(dr)}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    if bad:
        a, b = bad[0]
        diff = [(c, x, y) for c, x, y in zip(sc, a, b) if x != y]
        return False, f"{len(bad)} rows differ; first: {diff[:5]}"
    return True, f"{len(sr)} rows match"
