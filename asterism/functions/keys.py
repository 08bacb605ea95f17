"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asterism.operators.lookup import BROADCAST_LIMIT, table_bytes
from asterism.sources.staging import stage

_GROUP, _PLACE = "_key_group", "_key_place"
_SPAN_GROUP, _SPAN_SLICE, _SHIFT = "_key_span_group", "_key_span_slice", "_key_shift"


def add_surrogate_key(df: DataFrame, name: str) -> DataFrame:
    """Put a unique 64-bit id first: rising within a partition, neither dense nor
    stable across runs, and free of any shuffle.

    Write the result without a further shuffle: a shuffle after the id could mix
    two attempts of one task, which may number the same rows differently.
    """
    return df.select(F.monotonically_increasing_id().alias(name), *df.columns)


def add_ordered_key(df: DataFrame, name: str, within: Column, order_by: Sequence[str]) -> DataFrame:
    """Number rows 1, 2, 3 ... by ``order_by`` inside each ``within`` group.

    The numbers are those of ``row_number`` over the group, and repeat from run to
    run if ``order_by`` is unique in it, but no group is sorted by one task. Rows
    are range-partitioned by group and order, so a group spans as many slices as
    its size asks for, and staged with their place: slice number above bit 33,
    position in the slice below. The key is then the place, less the place of the
    group's first row in that slice, plus the group's rows in earlier slices.
    """
    ordered = df.withColumn(_GROUP, within).repartitionByRange(_GROUP, *order_by)
    placed = stage(
        ordered.sortWithinPartitions(_GROUP, *order_by).withColumn(_PLACE, F.monotonically_increasing_id())
    )

    slice_number = F.shiftright(_PLACE, 33)
    spans = placed.groupBy(F.col(_GROUP).alias(_SPAN_GROUP), slice_number.alias(_SPAN_SLICE)).agg(
        F.count(F.lit(1)).alias("size"), F.min(_PLACE).alias("first")
    )
    earlier = Window.partitionBy(_SPAN_GROUP).orderBy(_SPAN_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    spans = spans.select(_SPAN_GROUP, _SPAN_SLICE, (F.col("first") - before).alias(_SHIFT))
    if table_bytes(spans) <= BROADCAST_LIMIT:  # one row per slice and per further group in it
        spans = F.broadcast(spans)

    same_span = F.col(_GROUP).eqNullSafe(F.col(_SPAN_GROUP)) & (slice_number == F.col(_SPAN_SLICE))
    numbered = placed.join(spans, same_span)
    return numbered.select((F.col(_PLACE) - F.col(_SHIFT) + 1).alias(name), *df.columns)
