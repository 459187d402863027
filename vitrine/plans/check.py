"""Run a registered query in Spark and its SQL in DuckDB, and compare.

Comparison is by column names, row count and the sorted multiset of rows,
with exact equality (doubles included): the oracle SQL is written so that
both engines perform the same IEEE operations.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import DataFrame

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duckdb_connection(sf_dir: str):
    import os

    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir.rstrip('/')}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    return cols, sorted(rows, key=_key)


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    data = res.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    rows = [tuple(_norm(r[i]) for i in order) for r in data]
    return cols, sorted(rows, key=_key)


def compare(df: DataFrame, con, sql: str) -> dict:
    s_cols, s_rows = spark_rows(df)
    d_cols, d_rows = duck_rows(con, sql)
    out = {
        "columns_match": s_cols == d_cols,
        "spark_rows": len(s_rows),
        "duck_rows": len(d_rows),
        "values_match": s_cols == d_cols and s_rows == d_rows,
    }
    if not out["values_match"]:
        out["spark_columns"], out["duck_columns"] = s_cols, d_cols
        diff_s = [r for r in s_rows if r not in set(d_rows)][:3]
        diff_d = [r for r in d_rows if r not in set(s_rows)][:3]
        out["only_spark"], out["only_duck"] = diff_s, diff_d
    return out
