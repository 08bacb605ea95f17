"""Side-by-side comparison of a Spark result with its DuckDB oracle."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

# Spark type -> DuckDB type of the same column
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _canonical(pdf: pd.DataFrame) -> list[tuple]:
    """Rows as text, which also tells -0.0 from 0.0, in a fixed order."""
    return sorted(pdf[sorted(pdf.columns)].astype(str).itertuples(index=False, name=None))


def assert_same(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Same column names, types and multiset of rows; returns the row count."""
    relation = con.sql(sql)
    got = {name: TYPES[kind] for name, kind in spark_df.dtypes}
    want = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    assert got == want
    ours, theirs = _canonical(spark_df.toPandas()), _canonical(relation.df())
    assert len(ours) == len(theirs)
    assert ours == theirs
    return len(ours)
