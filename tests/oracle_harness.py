"""Side-by-side check of a Spark query and its DuckDB oracle (the same
shape of check the driver runs: row count, column names, and an
order-insensitive comparison of normalised values)."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}"
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


def rows_of(cols, tuples):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(t[i]) for i in order) for t in tuples), [cols[i] for i in order]


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    a, ac = rows_of(s_cols, s_rows)
    b, bc = rows_of(d_cols, d_rows)
    out = {"spark_rows": len(a), "oracle_rows": len(b), "cols_match": ac == bc,
           "values_match": a == b}
    if not out["values_match"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = sorted(sa - sb)[:3]
        out["only_oracle"] = sorted(sb - sa)[:3]
        out["spark_cols"], out["oracle_cols"] = ac, bc
    return out
