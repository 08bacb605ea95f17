"""Mix sources to target weights by systematic sampling.

Every document of a source expects the same number of copies, the source's target
over its size. The documents of a source are put in order of size and the expected
copies summed along it; with one random offset added, a document is emitted once
for each integer boundary that its step of the sum crosses. As sizes rise along the
order, the words taken differ from the target by less than the largest document.

The places in the order come from ranges, not from a window over the source, so a
source of any size is spread over tasks. Only the table of sources, a row each, is
ordered by one task.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asterism.functions.keys import add_ordered_key
from asterism.llm.common import count_words, small
from asterism.sources.staging import stage

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = 11


def offset(seed: int = SEED) -> float:
    """The one random start of the sampling, the same for a seed in every run."""
    return random.Random(seed).random()


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Target words for each row of ``sizes`` (source, source_size).

    Sources in code-point order, null last, take the weights in turn and share all
    words by them; a target stops at ``most`` times its source, and what is over is
    shared again until no target is above. That is a common level times the weight,
    or the stop where that is lower: ordered by stop over weight, the level follows
    from the sums of the sources before.
    """
    stop, weight = F.col("_stop"), F.col("weight")
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    rows = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    rows = rows.withColumn("_stop", F.col("source_size") * most)
    order = Window.orderBy(stop / weight, F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(stop).over(before), F.lit(0))
    weight_left = F.sum(weight).over(everything) - F.coalesce(F.sum(weight).over(before), F.lit(0))
    rows = rows.withColumns({"_place": F.row_number().over(order), "_level": left / weight_left})
    rows = rows.withColumn("_stopped", F.col("_level") >= stop / weight)
    level = F.min_by("_level", F.when(~F.col("_stopped"), F.col("_place"))).over(everything)
    target = F.when(F.col("_stopped"), stop.cast("double")).otherwise(level * weight)
    return rows.select("source", "source_size", "weight", target.alias("target"))


def _copies(rate: Column, place: Column, start: float, most: int) -> Column:
    upto = F.floor(F.lit(start) + rate * place)
    return F.least(upto - F.floor(F.lit(start) + rate * (place - 1)), F.lit(most)).cast("long")


def mix_sizes(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, seed: int = SEED
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken for each row of
    ``docs`` (doc_id, source, text); further columns of ``docs`` are passed on in ``row``
    by ``mixed_documents`` only.

    A null or empty text has size 0 and takes no words. A null source is one source,
    the last. Repeated rows, equal or null ids and ties of size each keep their own
    place, and those that are equal may trade it. An empty table gives an empty one.
    """
    return _mix(docs.select("doc_id", "source", count_words(F.col("text")).alias("size")), weights, most, seed)


def _mix(sized: DataFrame, weights: Sequence[int], most: int, seed: int) -> DataFrame:
    placed = add_ordered_key(sized, "place", F.col("source"), ["size", "doc_id"])
    sizes = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = small(stage(source_targets(sizes, weights, most)).withColumnRenamed("source", "_source"))
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = joined.withColumn("copies", _copies(rate, F.col("place"), offset(seed), most))
    return joined.withColumn("taken", F.col("copies") * F.col("size")).drop("_source", "place", "weight")


def mixed_documents(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, seed: int = SEED
) -> DataFrame:
    """The mix itself: each row of ``docs``, with all its columns, as often as it is taken."""
    sized = docs.select(
        F.struct(*docs.columns).alias("row"), "doc_id", "source", count_words(F.col("text")).alias("size")
    )
    taken = _mix(sized, weights, most, seed).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
