"""Spark result vs DuckDB oracle: columns, row count and an order-insensitive multiset."""

from __future__ import annotations

import datetime as _dt
import decimal
from collections import Counter

import duckdb

BASE_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, _dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, decimal.Decimal):
        return format(v.quantize(decimal.Decimal("0.01")) if v.as_tuple().exponent >= -2 else v, "f")
    if isinstance(v, float):
        return repr(round(v, 9))
    return str(v)


def rows_of(cols: list[str], rows) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(canon(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> dict:
    s_cols = df.columns
    s_rows = df.collect()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not out["columns_match"]:
        out["columns"] = (sorted(s_cols), sorted(d_cols))
        out["match"] = False
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    out["match"] = a == b
    if a != b:
        out["only_spark"] = list((a - b).items())[:3]
        out["only_oracle"] = list((b - a).items())[:3]
    return out
