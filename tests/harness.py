"""Local stand-in for the driver's correctness gate: run a registered query
in Spark and its oracle SQL in DuckDB over the same parquet directory, and
compare column names, row count and the multiset of rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

VIEWS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
         "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for v in VIEWS:
        p = os.path.join(sf_dir, f"{v}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("d", v.normalize() if v == v else str(v))
    if isinstance(v, float):
        return ("f", None if math.isnan(v) else round(v, 9))
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None))
    return ("v", v)


def rows_key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, name, query, sql):
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark-only {set(s_cols) - set(d_cols)}, "
                        f"duck-only {set(d_cols) - set(s_cols)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        a, b = rows_key(s_rows, s_cols), rows_key(d_rows, d_cols)
        if a != b:
            bad = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {bad}")
    return len(s_rows), problems
