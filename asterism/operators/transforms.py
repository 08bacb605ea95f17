"""Filter, project, rename, copy and de-duplicate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_equal(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose ``column`` equals ``value``; a null is not equal to anything."""
    return df.where(F.col(column) == F.lit(value))


def drop_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in each of ``columns``, as filters the scan can take over."""
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return df


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select ``{output name: source name or expression}`` in the given order."""
    return df.select(
        *((F.col(source) if isinstance(source, str) else source).alias(name) for name, source in columns.items())
    )


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename ``{old: new}`` in place."""
    return df.withColumnsRenamed(dict(names))


def copy_columns(df: DataFrame, copies: Mapping[str, str | Column]) -> DataFrame:
    """Add ``{new name: source column}``, so a directory key also stays in the file."""
    return df.withColumns(
        {name: F.col(source) if isinstance(source, str) else source for name, source in copies.items()}
    )


def hash_bucket(column: str, size: int) -> Column:
    """One of ``size`` buckets, by the first 16 bits of a text's MD5 digest; null for null."""
    return F.conv(F.substring(F.md5(F.col(column)), 1, 4), 16, 10).cast("int") % size


def distinct_rows(df: DataFrame) -> DataFrame:
    """One of each whole row (nulls equal each other).

    Spark aggregates within each map task before it shuffles, so a row repeated
    any number of times crosses the network at most once per task.
    """
    return df.dropDuplicates()
