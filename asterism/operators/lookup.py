"""Inner equi-join of a large stream of rows with a lookup table.

Three ways, each taken only if the one before does not do, and all with the same
rows as a plain inner join:

* measure the lookup; if it is small broadcast it, and nothing is shuffled, unless some
  split of the rows would give too many pairs: then the rows are dealt out evenly first;
* count the keys on both sides; if few lookup rows are asked for, broadcast those;
* shuffle both sides, but first cut the keys with a large share of the work into a
  grid of cells, so that no task gets a whole hot key. Rows whose key the other side
  lacks are dropped before that, by a broadcast filter of bounded size.

Choosing the way runs one to five Spark jobs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from math import ceil

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterism.operators.transforms import drop_null
from asterism.sources.staging import stage, staged

BROADCAST_LIMIT = 64 << 20
# a hot key's cells fall on tasks by hash, so smaller ones even out better
CELLS_PER_TASK = 4
# input rows and output pairs, above which a task's sort and output would spill or drag
WORK_PER_TASK = 4_000_000
# tasks of one shuffle that a driver can keep track of; more work is joined in slices
MOST_TASKS = 100_000

# bytes that ``table_bytes`` allows for a hash
HASH_BYTES = 120
# share of matched rows from which a filter before the shuffle would not pay
MOST_MATCHED = 0.9

_FILTER_ROW, _FILTER_BITS = "_filter_row", "_filter_bits"
_HASH, _ROWS, _COLS, _IDENTITY = "_key_hash", "_grid_rows", "_grid_cols", "_row_identity"
# types in which equal values have equal bytes, so equal hashes
_EXACT_KEYS = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)

Pairs = Sequence[tuple[str, str]]


class JoinFigures:
    """How many rows of a ``lookup_join`` match nothing, once its result has been computed.

    The number comes out of jobs that run anyway. Stages that are run again after a lost
    executor may be counted again in it.
    """

    def __init__(self) -> None:
        self.observation = Observation()
        self.counted: int | None = None

    def unmatched(self) -> int:
        if self.counted is None:  # without rows there is nothing to observe
            self.counted = int(observed(self.observation).get("unmatched", 0))
        return self.counted


def observed(observation: Observation) -> dict[str, int]:
    """The figures of an observation; none if adaptive execution found nothing to run there."""
    try:
        return dict(observation.get)
    except Py4JJavaError:
        return {}


def table_bytes(df: DataFrame) -> float:
    """Upper bound of the bytes all rows of ``df`` take as a hash table, but for its last page.

    Runs one aggregate over ``df`` and brings a single number to the driver. A row is
    stored twice at most, as key and as value: null bits, a slot of 8 bytes for each
    column, 16 bytes for a wide decimal or an interval, and texts to the next 8 bytes.
    To that come lengths, a chain pointer and up to four entries of 16 bytes in the
    pointer array. Nested columns have no bound.
    """
    row = _row_bytes(df)
    return float("inf") if row is None else df.agg(F.sum(row)).first()[0] or 0.0


def _row_bytes(df: DataFrame) -> Column | None:
    """What ``table_bytes`` adds up; None if there is no bound."""
    if any(isinstance(f.dataType, _NESTED) for f in df.schema):
        return None
    row = F.lit(8 * ceil(len(df.columns) / 64) + 8 * len(df.columns))
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            row = row + F.coalesce(F.octet_length(f.name) + 7, F.lit(0))
        elif isinstance(f.dataType, T.CalendarIntervalType) or (
            isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18
        ):
            row = row + 16
    return (2 * row + 24 + 64).cast("double")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Pairs,
    broadcast_limit: int = BROADCAST_LIMIT,
    min_tasks: int | None = None,
    most_tasks: int = MOST_TASKS,
    figures: JoinFigures | None = None,
) -> DataFrame:
    """Inner join on ``[(rows column, lookup column)]``, keeping both sides' columns.

    Null keys match nothing, text compares exactly, and a key present several
    times on both sides gives every pair. The shuffle join has as many tasks as the
    counted work asks for, and at least ``min_tasks`` (default:
    ``spark.sql.shuffle.partitions``); where that is above ``most_tasks`` it is done in
    several shuffles of that size, over slices of the keys and cells.
    Pass ``rows`` from a scan or a staged table: beyond the broadcast limit its keys
    are read once more to count them. ``figures`` learns how many rows match nothing.
    """
    _check(rows, lookup, on)
    size, repeated = _measured(lookup, on)
    if size <= broadcast_limit:
        return _broadcast_join(rows, lookup, on, repeated, figures)
    with staged(_count_keys(rows, lookup, on)) as counts:
        if size * _asked_share(counts) <= broadcast_limit:
            lookup = stage(_asked_for(lookup, on, counts))
            size, repeated = _measured(lookup, on)
            if size <= broadcast_limit:
                return _broadcast_join(rows, lookup, on, repeated, figures)
        return _join_in_cells(rows, lookup, on, counts, min_tasks, most_tasks, figures)


def grid_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Pairs,
    min_tasks: int | None = None,
    most_tasks: int = MOST_TASKS,
    figures: JoinFigures | None = None,
) -> DataFrame:
    """The shuffle join of ``lookup_join``, in which every hot key is spread over a grid of cells.

    A key with more than one task's share of all input rows and output pairs is
    hot, so there are fewer of them than tasks. With ``a`` grid rows and ``b``
    grid columns for a key, each of its left rows goes to one grid row and is
    repeated for the ``b`` columns, each of its lookup rows goes to one column and
    is repeated for the ``a`` rows: any pair meets in exactly one cell. The rows of
    a hot key that the other side lacks have no pair and are left out of the shuffle.
    """
    _check(rows, lookup, on)
    with staged(_count_keys(rows, lookup, on)) as counts:
        return _join_in_cells(rows, lookup, on, counts, min_tasks, most_tasks, figures)


def _measured(lookup: DataFrame, on: Pairs) -> tuple[float, bool]:
    """``table_bytes`` of the lookup, and whether a key is there twice, from one job.

    Rows are first added up by key, which sends each key once.
    """
    row = _row_bytes(lookup)
    if row is None:
        return float("inf"), True
    keys = [right for _, right in on]
    whole = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
    of_key = lookup.groupBy(F.when(whole, F.xxhash64(*keys)).alias(_HASH)).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row).alias("bytes")
    )
    size, most = of_key.agg(F.sum("bytes"), F.max(F.when(F.col(_HASH).isNotNull(), F.col("rows")))).first()
    return size or 0.0, (most or 0) > 1


def _broadcast_join(
    rows: DataFrame, lookup: DataFrame, on: Pairs, repeated: bool, figures: JoinFigures | None
) -> DataFrame:
    """Join with a lookup that fits a broadcast.

    If keys repeat in the lookup, the pairs that each split of the rows gives are
    counted. Where a split has too many, the rows are dealt out one by one to as many
    tasks as the pairs ask for, so equal rows part ways; Spark orders a split before
    dealing it, so a retried task deals alike.
    """
    if repeated:
        left_keys, right_keys = [left for left, _ in on], [right for _, right in on]
        of_key = drop_null(lookup, right_keys).groupBy(F.xxhash64(*right_keys).alias(_HASH)).agg(
            F.count(F.lit(1)).alias("n_right")
        )
        asked = drop_null(rows, left_keys).select(F.xxhash64(*left_keys).alias(_HASH), F.spark_partition_id().alias("split"))
        pairs = asked.join(F.broadcast(of_key), _HASH).groupBy("split").agg(F.sum("n_right").alias("pairs"))
        most, total = pairs.agg(F.max("pairs"), F.sum("pairs")).first()
        if (most or 0) > WORK_PER_TASK:
            least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            rows = rows.repartition(max(least, ceil(total / WORK_PER_TASK)))
    if figures is None:
        return rows.join(F.broadcast(lookup), _equal(on), "inner")
    # a row without a match comes out once, is counted and dropped
    joined = rows.join(F.broadcast(lookup), _equal(on), "left")
    found = F.col(on[0][1]).isNotNull()
    return joined.observe(figures.observation, F.count(F.when(~found, 1)).alias("unmatched")).where(found)


def _check(rows: DataFrame, lookup: DataFrame, on: Pairs) -> None:
    """Refuse what the shuffle join cannot do, also while the lookup is still small."""
    clash = set(rows.columns) & set(lookup.columns)
    if clash:
        raise ValueError(f"rename before joining, both sides have {sorted(clash)}")
    for left, right in on:
        kind, other = rows.schema[left].dataType, lookup.schema[right].dataType
        if kind != other or not (kind == T.StringType() or isinstance(kind, _EXACT_KEYS)):
            raise ValueError(f"{left} and {right} must share one exact type, not {kind} and {other}")


def _equal(on: Pairs) -> Column:
    return reduce(Column.__and__, (F.col(left) == F.col(right) for left, right in on))


def _count_keys(rows: DataFrame, lookup: DataFrame, on: Pairs) -> DataFrame:
    """Rows on each side per key hash, combined in the map tasks; those with a null key have no hash.

    Two keys that share a hash are counted and later placed together, which costs
    nothing: the join still compares keys.
    """
    sides = []
    for df, keys, name in ((rows, [k for k, _ in on], "n_left"), (lookup, [k for _, k in on], "n_right")):
        whole = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
        counted = df.groupBy(F.when(whole, F.xxhash64(*keys)).alias(_HASH)).agg(F.count(F.lit(1)).alias(name))
        sides.append(counted.withColumn(name, F.col(name).cast("double")))
    return sides[0].join(sides[1], _HASH, "full").na.fill(0.0, ["n_left", "n_right"])


def _asked_share(counts: DataFrame) -> float:
    """Share of the lookup's rows whose key some row has."""
    asked = F.sum(F.when(F.col("n_left") > 0, F.col("n_right")))
    return counts.agg(asked / F.greatest(F.sum("n_right"), F.lit(1.0))).first()[0] or 0.0


def _asked_for(lookup: DataFrame, on: Pairs, counts: DataFrame) -> DataFrame:
    """The lookup rows whose key some row has (and at most a few more, by equal hashes).

    There are no more such keys than such rows, so where the rows may be broadcast
    the 8-byte hashes of their keys may be too.
    """
    asked = counts.where((F.col("n_left") > 0) & (F.col("n_right") > 0)).select(_HASH)
    same_hash = F.xxhash64(*(right for _, right in on)) == F.col(_HASH)
    return lookup.join(F.broadcast(asked), same_hash, "left_semi")


def _join_in_cells(
    rows: DataFrame,
    lookup: DataFrame,
    on: Pairs,
    counts: DataFrame,
    min_tasks: int | None,
    most_tasks: int,
    figures: JoinFigures | None,
) -> DataFrame:
    left_keys, right_keys = [left for left, _ in on], [right for _, right in on]
    left, right = drop_null(rows, left_keys), drop_null(lookup, right_keys)
    spark = rows.sparkSession

    work = F.col("n_left") * F.col("n_right") + F.col("n_left") + F.col("n_right")
    meets = (F.col("n_left") > 0) & (F.col("n_right") > 0)
    matched = F.when(meets, F.col("n_left") + F.col("n_right"))
    keys, share, total, least, unmatched = counts.agg(
        F.count(matched),
        F.sum(matched) / F.sum(F.col("n_left") + F.col("n_right")),
        F.sum(F.when(F.col(_HASH).isNotNull(), work)),
        F.sum(F.when(meets, work)),
        F.sum(F.when(~meets, F.col("n_left"))),
    ).first()
    total = total or 0.0
    if figures is not None:
        figures.counted = int(unmatched or 0)
    only_matched = _key_filter(counts.where(meets).select(_HASH), keys) if (share or 0.0) < MOST_MATCHED else None
    if not only_matched:
        least = total
    least = least or 0.0
    min_tasks = min_tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(min_tasks, ceil(least / WORK_PER_TASK))
    # a filter of hashes lets some rows without a match pass: a hot key of those is still left out
    fair = F.when(meets, F.lit(least / tasks)).otherwise(F.lit(total / tasks))
    shares = counts.where(F.col(_HASH).isNotNull()).withColumn("fair_shares", work / fair)
    hot = _grid_shapes(shares).toArrow() if total else None

    if hot is not None and hot.num_rows:
        # a dimension of the grid that no key uses is left out: a constant would be dropped
        # from the join condition and the two sides would no longer be partitioned alike
        used = [count for count in (_ROWS, _COLS) if max(hot.column(count).to_pylist()) > 1]
        shapes = F.broadcast(spark.createDataFrame(hot))
        # the place in a file is known at the scan only
        left = _with_identity(left) if _ROWS in used else left
        right = _with_identity(right) if _COLS in used else right
    if only_matched:
        left, right = only_matched(left, left_keys), only_matched(right, right_keys)
    if hot is not None and hot.num_rows:
        left = _to_cells(left, left_keys, shapes, "_left", _ROWS, used)
        right = _to_cells(right, right_keys, shapes, "_right", _COLS, used)
        on = [*on, *((f"_left{count}", f"_right{count}") for count in used)]
    slices = ceil(tasks / most_tasks)
    names = [left for left, _ in on], [right for _, right in on]

    def joined(number: int) -> DataFrame:
        # an explicit count, since small inputs with a large output must not be merged into few tasks
        sides = []
        for df, keys in zip((left, right), names):
            if slices > 1:
                df = df.where(F.pmod(F.xxhash64(F.lit("slice"), *keys), F.lit(slices)) == number)
            sides.append(df.repartition(ceil(tasks / slices), *keys))
        return sides[0].join(sides[1].hint("merge"), _equal(on), "inner").select(*rows.columns, *lookup.columns)

    return reduce(DataFrame.unionAll, map(joined, range(slices)))


def _key_filter(hashes: DataFrame, count: int) -> Callable[[DataFrame, list[str]], DataFrame] | None:
    """A function that keeps the rows whose key has one of ``hashes``; None if there are too
    many of them for a broadcast to tell them from others.

    Up to the broadcast limit the hashes themselves are looked up. Beyond it they become a
    bitmap of 64 bits a hash, which lets one in 64 other rows pass, and more where the
    limit leaves fewer bits, until most others would.
    """
    if count * HASH_BYTES <= BROADCAST_LIMIT:
        few = F.broadcast(stage(hashes))
        return lambda df, keys: df.join(few, F.xxhash64(*keys) == F.col(_HASH), "left_semi")
    words = min(1 << (count - 1).bit_length(), BROADCAST_LIMIT // 16)
    if count > words * 32:
        return None
    bits = (words * 64).bit_length() - 1

    def place(of: Column) -> tuple[Column, Column, Column]:
        spot = F.shiftrightunsigned(of, 64 - bits)
        return F.shiftright(spot, 12), F.shiftright(spot, 6).bitwiseAND(63).cast("int"), spot.bitwiseAND(63).cast("int")

    # 64 words of 64 bits to a row
    row, word, bit = place(F.col(_HASH))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    found = hashes.groupBy(row.alias("row"), word.alias("word")).agg(F.bit_or(one).alias("bits"))
    by_word = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    dense = F.expr("transform(sequence(0, 63), w -> coalesce(by_word[w], 0L))")
    rows = found.groupBy(F.col("row").alias(_FILTER_ROW)).agg(by_word.alias("by_word"))
    bitmap = F.broadcast(stage(rows.select(_FILTER_ROW, dense.alias(_FILTER_BITS))))

    def keep(df: DataFrame, keys: list[str]) -> DataFrame:
        row, word, bit = place(F.xxhash64(*keys))
        there = F.call_function("shiftrightunsigned", F.get(_FILTER_BITS, word), bit).bitwiseAND(1) == 1
        return df.join(bitmap, row == F.col(_FILTER_ROW)).where(there).select(*df.columns)

    return keep


def _grid_shapes(counts: DataFrame) -> DataFrame:
    """Key hash and grid shape of each hot key: fewer rows of 16 bytes than there are tasks.

    The shape is 0 by 0 where one side has no row, so that there is nothing to join.
    """
    hot = counts.where(F.col("fair_shares") > 1)
    cells = F.ceil(F.col("fair_shares") * CELLS_PER_TASK)
    # the most nearly square share of pairs repeats the fewest rows
    square = F.round(F.sqrt(cells * F.col("n_left") / F.greatest("n_right", F.lit(1.0))))
    grid_rows = F.least(cells, F.greatest(F.lit(1), square))
    joins = F.least("n_left", "n_right") > 0
    shape = {_ROWS: grid_rows, _COLS: F.ceil(cells / grid_rows)}
    return hot.select(_HASH, *(F.when(joins, size).otherwise(0).cast("int").alias(c) for c, size in shape.items()))


def _to_cells(
    df: DataFrame, keys: list[str], shapes: DataFrame, prefix: str, own: str, used: Sequence[str]
) -> DataFrame:
    """Give each row one coordinate in its ``own`` dimension, and a copy for each in the other.

    The own coordinate comes from a hash of the row's place in its file: equal copies part
    ways, and a retried task repeats its choice.
    """
    columns = [c for c in df.columns if c != _IDENTITY]
    spread = F.col(_IDENTITY)
    marked = df.withColumn(_HASH, F.xxhash64(*keys)).join(shapes, _HASH, "left")
    marked = marked.where(F.coalesce(_ROWS, F.lit(1)) > 0)
    coordinates = []
    for count in used:
        if count == own:
            place = F.when(F.col(count) > 1, F.pmod(spread, F.col(count).cast("bigint")).cast("int")).otherwise(0)
        else:
            place = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(count), F.lit(1)) - 1))
        coordinates.append(place.alias(f"{prefix}{count}"))
    return marked.select(*columns, *coordinates)


def _with_identity(df: DataFrame) -> DataFrame:
    """``df`` with a hash of each row's file and place in it; rows that come from no
    Parquet scan are staged first."""
    try:
        place = df.metadataColumn("_metadata")
        return df.withColumn(_IDENTITY, F.xxhash64(place["file_path"], place["row_index"]))
    except AnalysisException:
        return _with_identity(stage(df))
