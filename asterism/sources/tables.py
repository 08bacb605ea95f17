"""Parquet tables: replace, read back by root or by leaf glob."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from asterism.operators.layout import cluster, rebalance
from asterism.sources.json_tree import dataset_path
from asterism.sources.versions import current_origin, current_version, finish_version, next_version


def write_table(
    df: DataFrame,
    root: str,
    name: str,
    keys: Sequence[str] = (),
    compact: bool = False,
    origin: str | None = None,
    lookup: str | None = None,
) -> str:
    """Replace the table ``name`` under ``root`` with ``df`` and return the address of its files.

    ``keys`` become directory levels. ``compact`` adds one exchange that gathers
    each directory's rows into files of the advisory size, and splits a directory
    too large for one task. It is for rows that no earlier step has laid out, and
    never for rows with a surrogate key, which must not be shuffled again.

    The rows go to a new version, which becomes the table when all of it is written: a
    write that fails leaves the table as it was, and ``df`` may read the table itself.
    The whole table is replaced whatever the session says of partitions.
    ``expire_versions`` frees what earlier versions take. ``origin`` names what the
    rows were made from, for ``made_from``.

    ``lookup`` is a column that rows will be looked up by. They are stored in ranges of it, for one
    exchange by range, with a Parquet Bloom filter for each row group: a read with
    ``where(column == value)`` then skips files and row groups that can't have the value, by
    their least and greatest values and by the filter. It is for tables without ``keys``.
    """
    if lookup is not None and (keys or compact):
        raise ValueError("either keys or lookup")
    spark = df.sparkSession
    version = next_version(spark, dataset_path(root, name))
    rows = rebalance(df, keys) if keys and compact else df
    rows = cluster(rows, lookup) if lookup else rows
    writer = rows.write.mode("errorifexists")
    if lookup:
        # adaptive: of filters of several sizes the smallest that does for a row group is kept
        writer = writer.option(f"parquet.bloom.filter.enabled#{lookup}", "true")
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    if keys:
        writer = writer.partitionBy(*keys)
    writer.parquet(version)
    finish_version(spark, version, origin)
    return version


def made_from(spark: SparkSession, root: str, name: str) -> str | None:
    """What the table ``name`` was made from as it is now, if its writer told."""
    return current_origin(spark, dataset_path(root, name))


def table_path(spark: SparkSession, root: str, name: str) -> str:
    """Address of the files that are the table ``name`` now."""
    return current_version(spark, dataset_path(root, name))


def read_table(
    spark: SparkSession,
    root: str,
    name: str,
    schema: str | None = None,
    leaf_depth: int | None = None,
    only: str | None = None,
) -> DataFrame:
    """Read a table back, as it is now.

    By default the root is read, so directory keys are columns and prune the
    listing; with a schema an empty table gives no rows, not an error.
    ``leaf_depth`` reads the data files under that many directory levels by glob
    instead, which loses the keys. ``only`` is a glob of key directories, for
    instance ``year_partition=2018`` or ``year_partition=2018/month_partition=1*``: no
    other directory is listed, and the keys are columns.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    path = table_path(spark, root, name)
    if leaf_depth is not None and only is not None:
        raise ValueError("either leaf_depth or only")
    if leaf_depth is not None:
        path = "/".join([path, *["*"] * leaf_depth, "*.parquet"])
    elif only is not None:
        reader, path = reader.option("basePath", path), dataset_path(path, only.strip("/"))
    return reader.parquet(path)
