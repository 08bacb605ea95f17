"""Tables laid out for look-ups by an id: a point read skips files and row groups."""

from __future__ import annotations

import fixture_data as fx
import pytest
from pyspark.sql import functions as F

from asterism.plans.jobs import load_star, run_star
from asterism.sources.schemas import SONG_KEYS_YEAR_TWICE as KEYS
from asterism.sources.tables import read_table, table_path, write_table

N = 20_000


@pytest.fixture
def small_row_groups(spark):
    """Many row groups in a file, whose values are in no dictionary, as with many more rows."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    settings = {"parquet.block.size": "65536", "parquet.enable.dictionary": "false", "parquet.block.size.row.check.min": "100"}
    for key, value in settings.items():
        conf.set(key, value)
    yield
    for key in settings:
        conf.unset(key)


def people(spark):
    ids = F.sha2(F.col("id").cast("string"), 256)
    return spark.range(0, N, 1, 8).select(ids.alias("user_id"), F.concat(F.lit("name of "), ids).alias("name"))


def point_read(spark, root, value):
    """Rows with that id, and how many the scan gave."""
    df = read_table(spark, root, "users").where(F.col("user_id") == value)
    found = df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return found, scan.metrics().apply("numOutputRows").value()


def test_a_point_read_skips_row_groups(spark, root, small_row_groups):
    rows = people(spark)
    write_table(rows, f"{root}/plain", "users")
    write_table(rows, f"{root}/by_id", "users", lookup="user_id")
    wanted = rows.where("name like '%77'").first()["user_id"]
    (found, many), (same, few) = (point_read(spark, f"{root}/{name}", wanted) for name in ("plain", "by_id"))
    assert found == same and len(found) == 1
    assert few <= 2 * 65536 / 140 and few * 10 < many  # a row has some 140 bytes, so one row group or two


def test_an_id_that_is_not_there_reads_no_row(spark, root, small_row_groups):
    rows = people(spark)
    write_table(rows, root, "users", lookup="user_id")
    ids = [r[0] for r in rows.orderBy("user_id").select("user_id").collect()]
    read = [point_read(spark, root, ids[i] + "x") for i in range(50, N, 1000)]  # between two that are
    assert not any(found for found, _ in read)
    assert sum(n == 0 for _, n in read) >= 0.8 * len(read)  # a Bloom filter errs now and then


def test_rows_are_the_same_nulls_ties_and_repeats_among_them(spark, root):
    data = [(None, "a"), (None, "a"), ("x", None), ("x", "b"), ("x", "b"), ("", "")] + [("hot", f"n{i}") for i in range(500)]
    rows = spark.createDataFrame(data, "user_id string, name string")
    write_table(rows, root, "users", lookup="user_id")
    got = read_table(spark, root, "users")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, data))
    write_table(rows.limit(0), root, "users", lookup="user_id")
    assert read_table(spark, root, "users", "user_id STRING, name STRING").count() == 0
    with pytest.raises(ValueError):
        write_table(rows, root, "users", ["name"], lookup="user_id")


def test_an_id_with_a_third_of_the_rows_is_spread(spark, root):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("user_id"), "id")
        write_table(rows, root, "users", lookup="user_id")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = read_table(spark, root, "users").groupBy(F.input_file_name()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 30_000 / 8 * 1.5


def test_the_jobs_lay_out_by_id(spark, root):
    source = fx.write_inputs(f"{root}/in")
    run_star(spark, source, f"{root}/plain", KEYS)
    run_star(spark, source, f"{root}/by_id", KEYS, by_id=True, resume=True)
    plain, by_id = (load_star(spark, f"{root}/{name}", KEYS) for name in ("plain", "by_id"))
    for name in ("artists", "users"):
        assert sorted(map(repr, plain[name].collect())) == sorted(map(repr, by_id[name].collect()))
    before = [table_path(spark, f"{root}/by_id", name) for name in ("artists", "users", "songs", "time")]
    run_star(spark, source, f"{root}/by_id", KEYS, resume=True)  # another layout is another table
    after = [table_path(spark, f"{root}/by_id", name) for name in ("artists", "users", "songs", "time")]
    assert [a == b for a, b in zip(before, after)] == [False, False, True, True]
