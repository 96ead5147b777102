"""Run a query in Spark and its SQL in DuckDB and compare all rows."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(sql: str, sf_dir: str) -> pd.DataFrame:
    with duckdb.connect() as con:
        for table in TABLES:
            path = Path(sf_dir) / f"{table}.parquet"
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
        return con.execute(sql).df()


def canonical(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows[sorted(rows.columns)].copy()
    for column in rows.columns:
        if column == "date":
            rows[column] = pd.to_datetime(rows[column])
        if pd.api.types.is_datetime64_any_dtype(rows[column]):
            rows[column] = rows[column].astype("datetime64[us]")
        if rows[column].dtype.kind == "O":
            rows[column] = rows[column].astype("string")
    return rows.sort_values(list(rows.columns), kind="stable").reset_index(drop=True)


def assert_same(result: DataFrame, sql: str, sf_dir: str) -> int:
    ours, theirs = canonical(result.toPandas()), canonical(oracle_rows(sql, sf_dir))
    assert list(ours.columns) == list(theirs.columns)
    assert len(ours) == len(theirs)
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, check_exact=True)
    for column in ours.columns:
        assert ours[column].dtype.kind == theirs[column].dtype.kind, column
    return len(ours)
