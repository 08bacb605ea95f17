"""Intermediate tables in storage every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from asterism.sources.json_tree import dataset_path

# what ``stage`` has written in the innermost ``freed`` block
_written: ContextVar[list[tuple[str, StructType]] | None] = ContextVar("written", default=None)


def scratch_root(spark: SparkSession) -> str:
    """A fresh, unused path below the folder of checkpoints: ``spark.checkpoint.dir``, or
    the one given to ``SparkContext.setCheckpointDir``.

    Where neither is set, a local-mode session gets a local folder; on a cluster
    it is an error, because a machine-local folder dies with its machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="asterism-")
    return dataset_path(shared, f"asterism-{uuid.uuid4().hex}")


def stage(df: DataFrame, root: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and continue from the files.

    Several consumers then share one evaluation, each reads only its columns,
    and a lost executor costs a re-read rather than the whole lineage. The files
    stay, since the result may be read at any later time, unless a ``freed`` block
    or ``staged`` ends them.
    """
    path = root or scratch_root(df.sparkSession)
    if root is None and (written := _written.get()) is not None:
        written.append((path, df.schema))
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Replace what ``stage`` writes in this ``with`` block by empty tables at its end."""
    mine: list[tuple[str, StructType]] = []
    token = _written.set(mine)
    try:
        with _emptied(spark, mine):
            yield
    finally:
        _written.reset(token)


@contextmanager
def _emptied(spark: SparkSession, tables: list[tuple[str, StructType]]) -> Iterator[None]:
    """Empty tables at the end of a block; an error of the block is the one that is raised."""

    def empty() -> None:
        for path, schema in tables:
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)

    try:
        yield
    except BaseException:
        with suppress(Exception):
            empty()
        raise
    empty()


@contextmanager
def staged(df: DataFrame, wanted: bool = True) -> Iterator[DataFrame]:
    """``stage`` for the length of a ``with`` block, then replace the files by an empty table.

    Without ``wanted`` the block gets ``df`` itself.
    """
    if not wanted:
        yield df
        return
    path = scratch_root(df.sparkSession)
    with _emptied(df.sparkSession, [(path, df.schema)]):
        yield stage(df, path)
