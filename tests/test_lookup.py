"""The lookup join against brute force, on skewed keys."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import asterism.operators.lookup as lookup_module
from asterism.operators.lookup import (
    _asked_for,
    _asked_share,
    _count_keys,
    _grid_shapes,
    grid_join,
    lookup_join,
    table_bytes,
)


def brute(left, right):
    return Counter((*a, *b) for a in left for b in right if a[0] is not None and a[0] == b[0])


def collected(df):
    return Counter(tuple(r) for r in df.collect())


def skewed(seed, n_left, n_right, hot_left, hot_right):
    """A third or more of each side on given keys, copies of one row, nulls, unmatched keys."""
    rnd = random.Random(seed)
    keys = [f"k{i}" for i in range(20)]

    def side(n, hot, tag):
        return [
            (None if rnd.random() < 0.05 else hot if rnd.random() < 0.5 else rnd.choice(keys), rnd.randrange(3), tag)
            for _ in range(n)
        ]

    return side(n_left, hot_left, "l"), side(n_right, hot_right, "r")


CASES = {
    "hot on both sides": (400, 200, "k1", "k1"),
    "hot left only": (600, 30, "k1", "k2"),
    "hot lookup only": (20, 900, "k1", "k2"),
    "hot and unmatched left": (600, 30, "nowhere", "k2"),
    "hot and unmatched lookup": (30, 600, "k2", "nowhere"),
}


@pytest.mark.parametrize("tasks", [1, 4, 64])
@pytest.mark.parametrize("case", CASES)
def test_grid_join(spark, case, tasks):
    left, right = skewed(len(case), *CASES[case])
    ldf = spark.createDataFrame(left, "a string, x int, y string").repartition(5)
    rdf = spark.createDataFrame(right, "b string, u int, v string").repartition(3)
    assert collected(grid_join(ldf, rdf, [("a", "b")], tasks)) == brute(left, right)


keys = st.none() | st.integers(-3, 3) | st.just(2**62)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(keys, max_size=120), st.lists(keys, max_size=60), st.integers(1, 50))
def test_grid_join_of_any_keys(spark, left, right, tasks):
    left, right = [(k, i) for i, k in enumerate(left)], [(k, i) for i, k in enumerate(right)]
    ldf = spark.createDataFrame(left, "a bigint, x bigint")
    rdf = spark.createDataFrame(right, "b bigint, u bigint")
    assert collected(grid_join(ldf, rdf, [("a", "b")], tasks)) == brute(left, right)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(keys, max_size=20), st.lists(keys, max_size=60), st.sampled_from([0, 300, 1000, 1 << 20]))
def test_lookup_join_of_any_size(spark, left, right, limit):
    left, right = [(k, i) for i, k in enumerate(left)], [(k, i) for i, k in enumerate(right)]
    ldf = spark.createDataFrame(left, "a bigint, x bigint")
    rdf = spark.createDataFrame(right, "b bigint, u bigint")
    assert collected(lookup_join(ldf, rdf, [("a", "b")], limit, 5)) == brute(left, right)


def test_both_ways_agree_on_two_keys(spark):
    left, right = skewed(7, 300, 200, "k1", "k1")
    ldf = spark.createDataFrame(left, "a string, x int, y string")
    rdf = spark.createDataFrame(right, "b string, u int, v string")
    on = [("a", "b"), ("x", "u")]
    expected = Counter((*p, *q) for p in left for q in right if p[0] is not None and p[:2] == q[:2])
    assert collected(lookup_join(ldf, rdf, on)) == expected
    assert collected(lookup_join(ldf, rdf, on, broadcast_limit=0, min_tasks=16)) == expected


def test_empty_sides(spark):
    ldf = spark.createDataFrame([("a",)], "a string")
    none = spark.createDataFrame([], "b string")
    for limit in (0, 1 << 20):
        assert lookup_join(ldf, none, [("a", "b")], limit).count() == 0
    assert grid_join(ldf.limit(0), none, [("a", "b")]).count() == 0


def test_text_is_compared_exactly(spark):
    ldf = spark.createDataFrame([("a",), ("A",), ("a ",), ("",), (None,)], "a string")
    rdf = spark.createDataFrame([("a",), ("",), (None,)], "b string")
    for limit in (0, 1 << 20):
        assert sorted(lookup_join(ldf, rdf, [("a", "b")], limit).collect()) == [("", ""), ("a", "a")]


def test_a_hot_key_is_spread_over_tasks(spark):
    """Nine tenths of the pairs are of one key and one repeated row, yet no task has a third of them."""
    hot = spark.range(0, 9000, 1, 12).select(F.lit("hot").alias("a"))
    cold = spark.range(0, 1000, 1, 4).select(F.concat(F.lit("c"), F.col("id") % 50).alias("a"))
    lookup = spark.createDataFrame([("hot",)] + [(f"c{i}",) for i in range(50)], "b string")
    joined = grid_join(hot.unionAll(cold), lookup, [("a", "b")], min_tasks=16)
    per_task = joined.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 10000
    assert max(r["count"] for r in per_task) < 10000 / 3


def test_hot_keys_without_a_match_are_not_shuffled(spark):
    gone = spark.range(5000).select(F.lit("gone").alias("a"))
    rows = gone.unionAll(spark.range(100).select(F.concat(F.lit("k"), F.col("id") % 10).alias("a")))
    lookup = spark.range(10).select(F.concat(F.lit("k"), F.col("id")).alias("b"))
    assert grid_join(rows, lookup, [("a", "b")], min_tasks=8).count() == 100
    counts = _count_keys(rows, lookup, [("a", "b")])
    shapes = _grid_shapes(counts.withColumn("fair_shares", F.col("n_left") / 600)).collect()
    assert [(r._grid_rows, r._grid_cols) for r in shapes] == [(0, 0)]


def test_a_hot_lookup_key_is_spread_while_the_lookup_is_cut(spark):
    rows = spark.range(100).select(F.concat(F.lit("k"), F.col("id") % 10).alias("a"))
    hot = spark.range(0, 6000, 1, 12).select(F.lit("k1").alias("b"), "id")
    lookup = hot.unionAll(spark.range(3000).select(F.concat(F.lit("k"), F.col("id")).alias("b"), "id"))
    counts = _count_keys(rows, lookup, [("a", "b")])
    assert _asked_share(counts) == 6010 / 9000
    cut = _asked_for(lookup, [("a", "b")], counts)
    per_task = [r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 6010
    assert max(per_task) < 6010 / 3


def test_tasks_grow_with_the_work(spark, monkeypatch):
    monkeypatch.setattr(lookup_module, "WORK_PER_TASK", 100)
    rows = spark.range(990).select((F.col("id") % 99).alias("a"))
    lookup = spark.range(99).select(F.col("id").alias("b"))
    joined = grid_join(rows, lookup, [("a", "b")])
    assert joined.count() == 990
    # 990 rows, 99 rows and 990 pairs make 21 tasks
    assert 15 < joined.groupBy(F.spark_partition_id()).count().count() <= 21


def test_equal_rows_of_one_split_are_spread(spark, root):
    spark.range(0, 200_000, 1, 1).select(F.lit("hot").alias("a")).write.parquet(root + "/rows")
    rows = spark.read.parquet(root + "/rows")
    lookup = spark.createDataFrame([("hot",)], "b string")
    for side in (rows, rows.union(rows.limit(0))):  # as scanned, and where a row has no place in a file
        joined = grid_join(side, lookup, [("a", "b")], min_tasks=16)
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) == 200_000
        assert max(per_task) < 200_000 / 4


def test_a_large_output_of_a_small_lookup_is_spread(spark, root, monkeypatch):
    monkeypatch.setattr(lookup_module, "WORK_PER_TASK", 20_000)
    spark.range(0, 2000, 1, 1).select(F.lit("hot").alias("a")).write.parquet(root + "/rows")
    rows = spark.read.parquet(root + "/rows")
    lookup = spark.range(100).select(F.lit("hot").alias("b"), "id")
    joined = lookup_join(rows, lookup, [("a", "b")])
    per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 200_000
    assert max(per_task) < 2 * 20_000


@pytest.mark.parametrize("most", [1, 3, 7])
def test_slices_give_the_same_rows(spark, most):
    left, right = skewed(5, 400, 200, "k1", "k1")
    ldf = spark.createDataFrame(left, "a string, x int, y string")
    rdf = spark.createDataFrame(right, "b string, u int, v string")
    assert collected(grid_join(ldf, rdf, [("a", "b")], 16, most)) == brute(left, right)


def records_shuffled(node):
    """Rows that each exchange of a plan has written, the largest first."""
    found = []
    if node.nodeName().startswith("Exchange"):
        found.append(node.metrics().apply("shuffleRecordsWritten").value())
    children = node.children()
    return sorted(sum((records_shuffled(children.apply(i)) for i in range(children.size())), found), reverse=True)


@pytest.mark.parametrize("bitmap", [False, True])
@pytest.mark.parametrize("skewed", [False, True])
def test_rows_without_a_match_are_not_shuffled(spark, root, monkeypatch, bitmap, skewed):
    if bitmap:
        monkeypatch.setattr(lookup_module, "HASH_BYTES", 1 << 40)
    every = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")) if skewed else F.col("id")
    spark.range(0, 400_000, 1, 8).select(every.alias("a"), F.col("id").alias("x")).write.parquet(root + "/rows")
    rows = spark.read.parquet(root + "/rows")
    lookup = spark.range(0, 40_000, 10, 4).select(F.col("id").alias("b"), F.lit("s").alias("s"))
    want = rows.join(lookup, F.col("a") == F.col("b")).count()
    assert want == (2666 if skewed else 4000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = grid_join(rows, lookup, [("a", "b")], min_tasks=16)
        found = collected(joined)
        assert found == collected(rows.join(lookup, F.col("a") == F.col("b")))
        most = records_shuffled(joined._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # rows of the plays, then of the lookup
    assert len(most) == 2
    assert most[0] <= (4000 + 400_000 // 50 if bitmap else 4000)


def test_a_key_filter_keeps_every_match(spark, monkeypatch):
    monkeypatch.setattr(lookup_module, "HASH_BYTES", 1 << 40)
    hashes = spark.range(0, 30_000, 1, 4).select(F.xxhash64("id").alias("_key_hash"))
    keep = lookup_module._key_filter(hashes, 30_000)
    kept = keep(spark.range(0, 300_000, 1, 4).withColumnRenamed("id", "row"), ["row"])
    assert kept.columns == ["row"]
    assert kept.where("row < 30000").count() == 30_000
    assert kept.count() <= 30_000 + 270_000 * 0.02
    # as full as the limit asks for, and none where it would let most rows pass
    monkeypatch.setattr(lookup_module, "BROADCAST_LIMIT", 1 << 14)
    kept = lookup_module._key_filter(hashes, 30_000)(spark.range(100_000).withColumnRenamed("id", "row"), ["row"])
    assert kept.where("row < 30000").count() == 30_000
    assert kept.count() < 80_000
    assert lookup_module._key_filter(hashes, 40_000) is None


def test_the_broadcast_way_measures_in_one_job(spark):
    before = lookup_module._measured(spark.createDataFrame([("a", "x")] * 2, "b string, v string"), [("b", "b")])
    assert before[1] and before[0] == 2 * (2 * (8 + 16 + 16) + 24 + 64)
    assert not lookup_module._measured(spark.createDataFrame([("a",), (None,), (None,)], "b string"), [("b", "b")])[1]
    assert lookup_module._measured(spark.range(0), [("id", "id")]) == (0.0, False)


TABLES = {
    "short texts": ["concat('k', id)", "concat('x', id)", "concat('y', id)"],
    "long text": ["concat(repeat('k', 60), id)"],
    "empty texts": ["concat('', id)", "''", "cast(null as string)"],
    "wide decimals": ["cast(id as decimal(38, 0))", "cast(id as decimal(38, 5))", "cast(1 as decimal(20, 0))"],
    "numbers": ["id", "cast(id as int)", "cast(id as double)"],
}


@pytest.mark.parametrize("name", TABLES)
def test_table_bytes_bounds_the_table_that_is_broadcast(spark, name):
    """The size Spark reports for the built table, less a page, is never above the estimate."""
    columns = [F.expr(sql).alias(f"c{i}") for i, sql in enumerate(TABLES[name])]
    lookup = spark.range(200_000).select(*columns)
    rows = spark.range(10).select(F.expr(TABLES[name][0]).alias("a"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = rows.join(F.broadcast(lookup), F.col("a") == F.col("c0"))
        joined.collect()
        size = broadcast_size(joined._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert size > 1 << 20
    page = 64 << 20 if size > 64 << 20 else 0
    assert size - page <= table_bytes(lookup)


def broadcast_size(node):
    """``data size`` of the one broadcast in a plan that ran."""
    if node.nodeName().startswith("BroadcastExchange"):
        return node.metrics().apply("dataSize").value()
    children = node.children()
    return max([0, *(broadcast_size(children.apply(i)) for i in range(children.size()))])


def test_table_bytes_measures_text(spark):
    row = 2 * (8 + 8) + 24 + 64
    assert table_bytes(spark.range(10).select(F.lit("x").alias("t"))) == 10 * (row + 2 * 8)
    assert table_bytes(spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))) > 20_000
    assert table_bytes(spark.range(10).select(F.lit(None).cast("string").alias("t"))) == 10 * row
    assert table_bytes(spark.range(0)) == 0
    assert table_bytes(spark.range(1).select(F.array("id").alias("t"))) == float("inf")


def test_refuses_what_it_cannot_join(spark):
    one = spark.range(1)
    with pytest.raises(ValueError, match="rename"):
        lookup_join(one, one, [("id", "id")])
    for join in (lookup_join, grid_join):
        for kind in ("int", "double"):
            with pytest.raises(ValueError, match="type"):
                join(one, one.select(F.col("id").cast(kind).alias("b")), [("id", "b")])
