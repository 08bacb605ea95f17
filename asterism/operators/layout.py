"""Placement of rows before a write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cluster(df: DataFrame, column: str) -> DataFrame:
    """Rows in ranges of ``column``, each sorted by it, so that few files and row groups have one value.

    Rows with one value are cut into ranges by a hash of the whole row, so a value with a
    third of them is spread as well; repeated rows stay together.
    """
    row = [F.col(f"`{c}`") for c in df.columns]
    place = [F.col(f"`{column}`"), F.xxhash64(*row)]
    return df.repartitionByRange(*place).sortWithinPartitions(*place)


def rebalance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring rows with equal ``columns`` together, in partitions of even size.

    Unlike ``repartition(columns)``, adaptive execution merges small partitions
    and spreads one that is too large over several tasks, so a directory holding
    a third of the table does not become one task. Without adaptive execution the
    rows stay where they are, which costs small files rather than one huge task.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        return df
    return df.hint("rebalance", *columns)
