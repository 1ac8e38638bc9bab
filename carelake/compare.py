"""Side-by-side check of a Spark query against its DuckDB SQL (tests, tools).

Rows are compared order-insensitively after sorting columns by name; values
must be equal (doubles compared exactly), and null positions must agree.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    return v


def rows_of_spark(df: DataFrame) -> tuple[list[str], Counter]:
    cols = sorted(df.columns)
    rows = df.select(*cols).collect()
    return cols, Counter(tuple(_norm(r[c]) for c in cols) for r in rows)


def rows_of_duck(con, sql: str) -> tuple[list[str], Counter]:
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    data = rel.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    return cols, Counter(tuple(_norm(r[i]) for i in order) for r in data)


def compare(df: DataFrame, con, sql: str) -> dict:
    s_cols, s_rows = rows_of_spark(df)
    d_cols, d_rows = rows_of_duck(con, sql)
    only_s = s_rows - d_rows
    only_d = d_rows - s_rows
    return {
        "columns_match": s_cols == d_cols,
        "spark_columns": s_cols,
        "duck_columns": d_cols,
        "spark_rows": sum(s_rows.values()),
        "duck_rows": sum(d_rows.values()),
        "match": s_cols == d_cols and not only_s and not only_d,
        "only_spark": list(only_s.elements())[:5],
        "only_duck": list(only_d.elements())[:5],
    }
