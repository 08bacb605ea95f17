"""Writes replace all of a table or nothing; readers find the version that was finished last."""

from __future__ import annotations

import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from asterism.sources.tables import read_table, table_path, write_table
from asterism.sources.versions import current_version, expire_versions, finish_version, next_version


def ids(df):
    return sorted(r["id"] for r in df.collect())


def failing(spark, n=1000):
    """Rows of which one, in the last of several tasks, can't be made."""
    bad = F.when(F.col("id") == n - 1, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("id"))
    return spark.range(0, n, 1, 8).select(bad.alias("id"), (F.col("id") % 3).alias("k"))


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_a_failed_rerun_keeps_the_old_rows(spark, root, keys):
    old = spark.range(1000).select("id", (F.col("id") % 3).alias("k"))
    write_table(old, root, "t", keys)
    with pytest.raises(Exception, match="broken row"):
        write_table(failing(spark), root, "t", keys)
    assert ids(read_table(spark, root, "t")) == list(range(1000))
    assert ids(read_table(spark, root, "t", "id BIGINT, k BIGINT")) == list(range(1000))
    assert ids(read_table(spark, root, "t", leaf_depth=len(keys))) == list(range(1000))
    write_table(old.where("id < 10"), root, "t", keys)
    assert ids(read_table(spark, root, "t")) == list(range(10))


def test_a_first_write_that_fails_leaves_no_table(spark, root):
    with pytest.raises(Exception, match="broken row"):
        write_table(failing(spark), root, "t")
    with pytest.raises(Exception, match="(?i)schema"):
        read_table(spark, root, "t")


def test_a_reader_keeps_its_version(spark, root):
    write_table(spark.range(5), root, "t")
    before = read_table(spark, root, "t")
    write_table(spark.range(7), root, "t")
    assert before.count() == 5 and read_table(spark, root, "t").count() == 7


def test_a_table_may_be_made_from_itself(spark, root):
    write_table(spark.range(5), root, "t")
    write_table(read_table(spark, root, "t").select((F.col("id") + 10).alias("id")), root, "t")
    assert ids(read_table(spark, root, "t")) == [10, 11, 12, 13, 14]


def test_only_some_directories(spark, root):
    rows = spark.range(24).select("id", (F.col("id") % 2 + 2017).cast("int").alias("y"), (F.col("id") % 12).cast("int").alias("m"))
    write_table(rows, root, "t", ["y", "m"])
    one = read_table(spark, root, "t", only="y=2018")
    assert one.columns == ["id", "y", "m"]
    assert ids(one) == list(range(1, 24, 2))
    assert len(one.inputFiles()) == len(list(Path(table_path(spark, root, "t")).glob("y=2018/*/*.parquet")))
    months = read_table(spark, root, "t", "id BIGINT, y INT, m INT", only="y=*/m=1*")
    assert {(r["y"], r["m"]) for r in months.collect()} == {(2018, 1), (2017, 10), (2018, 11)}
    with pytest.raises(ValueError):
        read_table(spark, root, "t", leaf_depth=2, only="y=2018")


def test_a_plain_table_is_read_and_then_replaced(spark, root):
    spark.range(3).write.parquet(root + "/t")
    assert table_path(spark, root, "t") == root + "/t"
    assert read_table(spark, root, "t").count() == 3
    write_table(spark.range(4), root, "t")
    assert read_table(spark, root, "t").count() == 4


def test_an_empty_table_has_a_version(spark, root):
    write_table(spark.range(4), root, "t")
    write_table(spark.range(0).withColumn("k", F.lit(1)), root, "t", ["k"])
    assert read_table(spark, root, "t", "id BIGINT, k INT").count() == 0


def test_versions_expire(spark, root):
    table = root + "/t"
    for n in (1, 2, 3):
        write_table(spark.range(n), root, "t")
    with pytest.raises(Exception, match="broken row"):
        write_table(failing(spark), root, "t")
    assert len(expire_versions(spark, table, keep=2)) == 1
    assert read_table(spark, root, "t").count() == 3
    folders = {p.name for p in Path(table, "_versions").iterdir() if p.is_dir()}
    assert len(folders) == 3  # two finished ones, and one that a writer may still be at work on
    for name in folders:
        os.utime(Path(table, "_versions", name), (time.time() - 4 * 86400,) * 2)
    assert len(expire_versions(spark, table)) == 2
    left = [p.name for p in Path(table, "_versions").iterdir() if not p.name.startswith(".")]
    assert len(left) == 2 and read_table(spark, root, "t").count() == 3
    with pytest.raises(ValueError):
        expire_versions(spark, table, keep=0)
    assert expire_versions(spark, root + "/nothing") == []


def test_writers_at_once_end_in_one_table(spark, root):
    """The version that was begun later is the table, whichever ends first."""
    table = root + "/t"
    first = next_version(spark, table)
    spark.range(1).write.parquet(first)
    second = next_version(spark, table)
    assert first < second
    spark.range(2).write.parquet(second)
    assert current_version(spark, table) == table
    finish_version(spark, second)
    finish_version(spark, first)
    assert current_version(spark, table) == second
    with pytest.raises(FileExistsError):
        finish_version(spark, first)
    assert read_table(spark, root, "t").count() == 2
