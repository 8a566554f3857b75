"""Runs a driver query in Spark and its oracle SQL in DuckDB, and compares them the way the
driver does: column names, row count and an order-insensitive comparison of values."""

from __future__ import annotations

import datetime
import decimal
import math

import os

import duckdb

STRICT = os.environ.get("ORACLE_STRICT") == "1"

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return v if STRICT else round(float(v), 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    out = {"spark_cols": s_cols, "duck_cols": d_cols, "spark_rows": len(s_rows), "duck_rows": len(d_rows)}
    out["schema_match"] = sorted(s_cols) == sorted(d_cols)
    out["count_match"] = len(s_rows) == len(d_rows)
    if out["schema_match"]:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        a = sorted((tuple(_norm(r[i]) for i in order_s) for r in s_rows), key=repr)
        b = sorted((tuple(_norm(r[i]) for i in order_d) for r in d_rows), key=repr)
        out["value_match"] = a == b
        if not out["value_match"]:
            diff_a = [x for x in a if x not in b][:3]
            diff_b = [x for x in b if x not in a][:3]
            out["only_spark"] = diff_a
            out["only_duck"] = diff_b
    else:
        out["value_match"] = False
    return out
