"""Run a query in Spark and its oracle in DuckDB and compare the rows."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of text, columns in name order; missing values as None."""
    ordered = frame[sorted(frame.columns)].astype(object)
    ordered = ordered.where(ordered.notna(), None)
    return sorted(tuple(repr(_plain(v)) for v in row) for row in ordered.itertuples(index=False))


def _plain(value):
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if hasattr(value, "item"):
        return value.item()
    return value


def differences(spark_frame: pd.DataFrame, oracle_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(oracle_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(oracle_frame.columns)}"
    left, right = rows(spark_frame), rows(oracle_frame)
    if left == right:
        return None
    only_left = [r for r in left if r not in set(right)][:2]
    only_right = [r for r in right if r not in set(left)][:2]
    return f"{len(left)} rows against {len(right)}; only Spark: {only_left}; only SQL: {only_right}"
