"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asterism.operators.lookup import BROADCAST_LIMIT, table_bytes
from asterism.sources.json_tree import dataset_path

# White space of the contracts is the space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
WHITE_SPACE = " \t\n\x0b\x0c\r"

ROWS_AT_ONCE = 512


def share_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver has it.

    On a cluster the package comes with ``--py-files`` or is installed.
    """
    here = Path(__file__).resolve().parents[2]
    paths = dict.fromkeys([str(here), *filter(None, spark.sparkContext.environment.get("PYTHONPATH", "").split(":"))])
    spark.sparkContext.environment["PYTHONPATH"] = ":".join(paths)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(dataset_path(sf_dir, f"{name}.parquet"))


def without(text: Column, characters: str) -> Column:
    """``text`` less every one of ``characters``."""
    return F.translate(text, characters, "")


def count_words(text: Column) -> Column:
    """Number of words in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows that, else as it is."""
    return F.broadcast(df) if table_bytes(df) <= BROADCAST_LIMIT else df


def map_rows(
    df: DataFrame, per_batch: Callable[[dict[str, list]], dict[str, list]], schema: str
) -> DataFrame:
    """Apply a function of column lists to rows, some at once; its result has the columns of ``schema``."""
    spark = df.sparkSession
    arrow = to_arrow(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            got = per_batch(batch.to_pydict())
            yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of a few rows, so that little is held as Python objects; at
    the end what the batches took is given back, as workers are used again."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)
    give_back()


def give_back() -> None:
    """Return to the system what a finished task has freed; only glibc needs the second call."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def to_arrow(spark: SparkSession, schema: str) -> pa.Schema:
    """The Arrow form of a schema given as Spark DDL."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))
