"""Comparison of registered queries with their SQL in DuckDB."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def plain(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return bool(v)
        return int(v) if isinstance(v, float) and v.is_integer() else (v.item() if hasattr(v, "item") else v)

    rows = [tuple(plain(v) for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(rows, key=repr)
