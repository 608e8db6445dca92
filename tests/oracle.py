"""Comparison of a query with its SQL."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)

    def value(v):
        if v is None or (isinstance(v, float) and v != v) or v is pd.NA:
            return None
        if isinstance(v, float) and v.is_integer():
            return int(v)
        return v.item() if hasattr(v, "item") else v

    rows = [tuple(value(v) for v in row) for row in frame[columns].itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def compare(spark_frame, con, sql: str) -> tuple[int, str | None]:
    """Row count and the first difference, if any."""
    mine = spark_frame.toPandas()
    theirs = con.execute(sql).df()
    if sorted(mine.columns) != sorted(theirs.columns):
        return len(mine), f"columns {sorted(mine.columns)} != {sorted(theirs.columns)}"
    if len(mine) != len(theirs):
        return len(mine), f"rows {len(mine)} != {len(theirs)}"
    for left, right in zip(normal(mine), normal(theirs), strict=True):
        if left != right:
            return len(mine), f"{left!r} != {right!r}"[:1500]
    return len(mine), None
