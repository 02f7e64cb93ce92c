"""Run a query and its SQL over the same folder and compare rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def sql_rows(sql: str, folder: str) -> pd.DataFrame:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) and glob.glob(path + '/*.parquet') else path}')")
    return con.execute(sql).fetchdf()


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return ""
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return f"{float(v):.9g}"
    return str(v)


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    columns = sorted(pdf.columns)
    return sorted(tuple(plain(v) for v in row) for row in pdf[columns].itertuples(index=False))


def compare(spark_df, sql: str, folder: str) -> str:
    got, want = spark_df.toPandas(), sql_rows(sql, folder)
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    a, b = rows_of(got), rows_of(want)
    if a != b:
        odd = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return f"{len(a)} rows against {len(b)}; first differences {odd}"
    return ""
