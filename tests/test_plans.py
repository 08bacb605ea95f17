"""Physical plans: what is pushed down, pruned, shuffled and spread."""

from __future__ import annotations

import contextlib
import io
import re
from pathlib import Path

import fixture_data as fx
import pytest
from pyspark.sql import functions as F

from asterism.operators.layout import rebalance
from asterism.operators.lookup import grid_join, lookup_join
from asterism.operators.transforms import project
from asterism.plans.dimensions import build_artists, build_songs, build_time, build_users
from asterism.plans.fact import build_songplays
from asterism.plans.jobs import read_catalogue, read_log, select_plays
from asterism.sources.schemas import SONG_KEYS_YEAR_TWICE
from asterism.sources.tables import read_table, write_table


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange (?:hash|range)partitioning\(.*?\), \w+", text)


def read_schema(text: str) -> set[str]:
    return {field.split(":")[0] for field in re.search(r"ReadSchema: struct<(.*)>", text).group(1).split(",")}


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = fx.write_inputs(str(tmp_path_factory.mktemp("in")))
    return select_plays(read_log(spark, root)), read_catalogue(spark, root)


def test_the_event_filter_reaches_the_json_scan(inputs):
    text = plan(build_users(inputs[0]))
    assert "EqualTo(page,NextSong)" in text
    assert read_schema(text) == {"page", "userId", "firstName", "lastName", "gender", "level"}


def test_time_reads_and_shuffles_one_column(inputs):
    text = plan(build_time(inputs[0]))
    assert read_schema(text) == {"page", "ts"}
    (exchange,) = exchanges(text)
    assert re.fullmatch(r"Exchange hashpartitioning\(start_time#\d+, \d+\), ENSURE_REQUIREMENTS", exchange)


def test_time_is_gathered_by_month_before_it_grows_wide(inputs):
    text = plan(build_time(inputs[0], compact=True))
    rebalanced = text.index("REBALANCE_PARTITIONS_BY_COL")
    assert text.index("weekofyear") < rebalanced  # nearer the root, so after the exchange


def test_songs_are_shuffled_without_their_copied_keys(inputs):
    text = plan(build_songs(inputs[1], SONG_KEYS_YEAR_TWICE))
    (exchange,) = exchanges(text)
    assert exchange.count("#") == 5
    assert read_schema(text) == {"song_id", "title", "artist_id", "year", "duration"}


@pytest.mark.parametrize("build", [build_users, build_artists])
def test_distinct_combines_before_the_shuffle(inputs, build):
    text = plan(build(inputs[build is build_artists]))
    assert re.search(r"HashAggregate.*\n.*Exchange.*\n.*HashAggregate", text)


def test_small_songs_are_broadcast_and_nothing_is_shuffled(inputs):
    text = plan(build_songplays(*inputs))
    assert "BroadcastHashJoin" in text
    assert not exchanges(text)


def test_large_songs_cost_one_exchange_per_side_and_none_follows_the_key(inputs):
    text = plan(build_songplays(*inputs, broadcast_limit=0))
    assert "SortMergeJoin" in text
    assert len(exchanges(text)) == 2
    key = text.index("monotonically_increasing_id")
    assert not exchanges(text[:key])


def test_the_fact_is_gathered_before_it_is_keyed(inputs):
    text = plan(build_songplays(*inputs, compact=True))
    assert text.index("monotonically_increasing_id") < text.index("REBALANCE_PARTITIONS_BY_COL")


def test_dedup_happens_below_the_join_and_before_the_key(inputs):
    text = plan(build_songplays(*inputs, dedup_before_id=True))
    assert len(exchanges(text)) == 3  # plays, songs, matched rows
    assert "HashAggregate" in text[: text.index("Exchange")]  # the key is added in the final aggregate


def test_repeated_plays_do_not_multiply(spark):
    fields = "start_time timestamp_ntz, userId string, level string, song string, sessionId long, location string, userAgent string"
    one = spark.createDataFrame([(None, "1", "free", "T", 1, "L", "U")], fields)
    plays = spark.range(50_000).join(one).drop("id")
    songs = spark.range(20).select(F.lit("T").alias("title"), F.col("id").cast("string").alias("song_id"), F.lit("A").alias("artist_id"))
    fact = build_songplays(plays, songs, dedup_before_id=True)
    assert fact.count() == 20
    joins = [line for line in plan(fact).split("\n") if "Join" in line]
    below = plan(fact)[plan(fact).index(joins[-1]) if len(joins) == 1 else plan(fact).index(joins[0]) :]
    assert "HashAggregate" in below


def test_a_large_lookup_of_which_little_is_asked_for_is_broadcast(spark):
    rows = spark.range(1000).select((F.col("id") % 20).alias("a"), F.col("id").alias("x"))
    lookup = spark.range(100_000).select(F.col("id").alias("b"), F.repeat(F.lit("x"), 50).alias("t"))
    df = lookup_join(rows, lookup, [("a", "b")], broadcast_limit=10_000)
    text = plan(df)
    assert "BroadcastHashJoin" in text
    assert not exchanges(text)
    assert df.count() == 1000


@pytest.mark.parametrize("hot_left, hot_right", [(900, 1), (1, 900), (300, 300)])
def test_grid_join_shuffles_each_side_once(spark, hot_left, hot_right):
    def side(hot, name):
        cold = spark.range(100).select(F.concat(F.lit("c"), F.col("id")).alias(name))
        return spark.range(hot).select(F.concat(F.lit("hot"), F.lit("")).alias(name)).unionAll(cold)

    df = grid_join(side(hot_left, "a"), side(hot_right, "b"), [("a", "b")], min_tasks=20)
    text = plan(df)
    assert [e.split(", ")[-2:] for e in exchanges(text)] == [["20)", "REPARTITION_BY_NUM"]] * 2
    assert df.count() == hot_left * hot_right + 100


def test_without_adaptive_execution_no_directory_becomes_one_task(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert not exchanges(plan(rebalance(spark.range(10), ["id"])))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "REBALANCE" in plan(rebalance(spark.range(10), ["id"]))


def test_directory_keys_prune_a_root_read(spark, root):
    write_table(project(spark.range(10), {"id": "id", "k": F.col("id") % 5}), root, "t", ["k"])
    text = plan(read_table(spark, root, "t", "id BIGINT, k BIGINT").where("k = 3"))
    assert re.search(r"PartitionFilters: \[.*k#\d+L = 3", text)


def test_a_hot_directory_is_written_by_several_tasks(spark, root):
    """Two thirds of the rows go to one directory, the rest to fifty."""
    key = F.when(F.col("id") % 3 < 2, F.lit(0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(50)) + 1)
    rows = spark.range(0, 300_000, 1, 8).select("id", F.xxhash64("id").alias("v"), key.alias("k"))
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100k",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        path = write_table(rows, root, "t", ["k"], compact=True)
    finally:
        for name in settings:
            spark.conf.unset(name)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in Path(path).glob("k=*")}
    assert len(files) == 51
    assert files.pop("k=0") >= 4
    assert sum(files.values()) < 50 * 8 / 2  # each input task on its own would write one file per key
    assert spark.read.parquet(path).count() == 300_000
