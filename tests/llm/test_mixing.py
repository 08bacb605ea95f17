import os

import pytest
from check import assert_same, connect
from conftest import rows_of
from pyspark.sql import functions as F

from asterism.llm import mixing
from asterism.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def filled(sizes, weights=(1, 2, 3), most=3):
    """Targets by resharing the excess again and again, as the words have it."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize(
    "sizes", [{"a": 10}, {"a": 5, "b": 100, None: 7}, {"z": 0, "y": 3, "x": 1000, "é": 50}, {"a": 0, "b": 0}, {}]
)
def test_targets(spark, sizes):
    table = spark.createDataFrame([*sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
    want = filled(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)
    assert all(got[s] <= 3 * sizes[s] for s in sizes)


def test_words_taken_come_near_the_targets(spark):
    rows = QUERIES["op1_mix"](spark, SF_DIR).collect()
    taken, target, longest = {}, {}, {}
    for r in rows:
        key = r["source_size"]
        taken[key] = taken.get(key, 0) + r["taken"]
        target[key], longest[key] = r["target"], max(longest.get(key, 0), r["size"])
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert all(abs(taken[k] - target[k]) <= longest[k] for k in taken)


def test_oracle(spark):
    assert assert_same(QUERIES["op1_mix"](spark, SF_DIR), connect(SF_DIR), ORACLES["op1_mix"]) > 0


def test_reruns_agree(messy):
    assert rows_of(mixing.mix_sizes(messy)) == rows_of(mixing.mix_sizes(messy))


def test_odd_rows(messy):
    rows = mixing.mix_sizes(messy).collect()
    assert len(rows) == messy.count()
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mixed_documents(messy).count() == sum(r["copies"] for r in rows)


def test_a_hot_source_is_spread(spark, documents):
    docs = documents([(i, "a b c d", "hot" if i % 3 else "cold") for i in range(3000)]).repartition(8)
    # as on a cluster, where each slice is large: so small ones would be merged
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        numbered = mixing.add_ordered_key(docs.select("doc_id", "source"), "place", docs["source"], ["doc_id"])
        hot = numbered.where("source = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(r["count"] for r in hot) == 2000
    assert len(hot) >= 4 and max(r["count"] for r in hot) < 1000
