"""Differential check helper: a Spark DataFrame against DuckDB SQL on the same parquet."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)].copy()
    for c in pdf.columns:
        s = pdf[c]
        if pd.api.types.is_float_dtype(s):
            pdf[c] = s.round(6).map(lambda v: "NULL" if pd.isna(v) else repr(float(v) + 0.0))
        elif pd.api.types.is_bool_dtype(s):
            pdf[c] = s.map(lambda v: "NULL" if pd.isna(v) else str(bool(v)))
        elif pd.api.types.is_integer_dtype(s):
            pdf[c] = s.map(lambda v: "NULL" if pd.isna(v) else str(int(v)))
        else:
            pdf[c] = s.map(lambda v: "NULL" if v is None or (isinstance(v, float) and pd.isna(v)) else str(v))
    return pdf.sort_values(list(pdf.columns)).reset_index(drop=True)


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    left = spark_df.toPandas()
    right = con.sql(sql).df()
    if sorted(left.columns) != sorted(right.columns):
        return False, f"columns differ: {sorted(left.columns)} vs {sorted(right.columns)}"
    if len(left) != len(right):
        return False, f"rows differ: {len(left)} vs {len(right)}"
    for c in left.columns:  # whole numbers with missing values reach pandas as floats on one side
        for x, y in ((left, right), (right, left)):
            if pd.api.types.is_float_dtype(x[c]) and pd.api.types.is_integer_dtype(y[c]):
                x[c] = x[c].astype("Int64")
    a, b = _norm(left), _norm(right)
    if not a.equals(b):
        diff = (a != b).any(axis=1)
        return False, f"values differ in {int(diff.sum())} rows; first:\n{a[diff].head(3)}\n{b[diff].head(3)}"
    return True, f"{len(left)} rows match"
