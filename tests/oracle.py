"""Compare the registered queries with their SQL on one scale."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connect(sf_dir: str = SF) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(df: pd.DataFrame) -> list[tuple]:
    def cell(x):
        if x is None or (not hasattr(x, "__len__") and pd.isna(x)):
            return None
        if isinstance(x, float):
            return round(x, 6)
        if isinstance(x, bool) or type(x).__name__ in ("bool_", "bool"):
            return bool(x)
        if hasattr(x, "isoformat"):
            return pd.Timestamp(x).isoformat()
        return int(x) if type(x).__name__.startswith(("int", "uint")) else round(float(x), 6) if type(x).__name__ == "float64" else x

    df = df[sorted(df.columns)]
    return sorted((tuple(cell(x) for x in row) for row in df.itertuples(index=False)), key=lambda r: tuple((x is None, str(x)) for x in r))


def differs(spark_df, sql: str, con: duckdb.DuckDBPyConnection) -> str:
    got, want = spark_df.toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    a, b = plain(got), plain(want)
    if a != b:
        first = next(((x, y) for x, y in zip(a, b, strict=False) if x != y), None)
        return f"{len(a)} and {len(b)} rows; first difference {first}"
    return ""
