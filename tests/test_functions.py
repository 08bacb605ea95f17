"""Time, keys, transforms and sessions on small rows."""

from __future__ import annotations

from datetime import datetime, timedelta

import job
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from asterism.functions.keys import add_ordered_key, add_surrogate_key
from asterism.functions.timeparts import CALENDAR, add_calendar, epoch_ms_to_timestamp
from asterism.operators.transforms import copy_columns, distinct_rows, keep_equal, project, rename_columns
from asterism.session import COMMITTERS, create_session, object_store_conf
from asterism.sources.staging import scratch_root, stage
from workload.standins import epoch_ms

EPOCH = datetime(1970, 1, 1)
few_examples = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@few_examples
@given(st.lists(st.integers(-(10**13), 10**13), min_size=1, max_size=200))
def test_epoch_ms_is_exact_both_ways(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "ms bigint").select(
        "ms", epoch_ms_to_timestamp("ms").alias("t")
    )
    for ms, t, back in df.select("ms", "t", epoch_ms("t")).collect():
        assert t == EPOCH + timedelta(milliseconds=ms)
        assert back == ms


def test_epoch_ms_where_the_session_zone_skips_an_hour(spark):
    skipped = datetime(2024, 3, 10, 2, 30)
    df = spark.createDataFrame([(skipped,)], "t timestamp_ntz")
    assert df.select(epoch_ms_to_timestamp(epoch_ms("t"))).first()[0] == skipped


@few_examples
@given(st.lists(st.datetimes(datetime(1900, 1, 1), datetime(2200, 1, 1)), min_size=1, max_size=200))
def test_calendar_matches_python(spark, values):
    df = add_calendar(spark.createDataFrame([(v,) for v in values], "start_time timestamp_ntz"))
    assert df.columns == ["start_time", *CALENDAR]
    for t, hour, day, week, month, year, weekday in df.collect():
        assert (hour, day, month, year) == (t.hour, t.day, t.month, t.year)
        assert (week, weekday) == (t.isocalendar().week, t.isoweekday() % 7 + 1)


def test_calendar_of_null(spark):
    df = add_calendar(spark.createDataFrame([(None,)], "start_time timestamp_ntz"))
    assert set(df.first()) == {None}


def test_surrogate_key_is_unique_and_rises_within_a_partition(spark):
    df = add_surrogate_key(spark.range(1000).repartition(7), "k").withColumn("p", F.spark_partition_id())
    rows = df.collect()
    assert df.columns == ["k", "id", "p"]
    assert len({r.k for r in rows}) == 1000
    for p in {r.p for r in rows}:
        keys = [r.k for r in rows if r.p == p]
        assert keys == sorted(keys)


def test_ordered_key_numbers_a_hot_group_over_many_slices(spark):
    """One group holds most rows and one order value most of those; one group is null."""
    df = spark.range(3000).select(
        F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2990, F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(42).alias("o"),
        "id",
    )
    numbered = add_ordered_key(df, "k", F.col("g"), ["o", "id"])
    assert numbered.columns == ["k", "g", "o", "id"]
    seen = {}
    for row in numbered.collect():
        seen.setdefault(row.g, []).append((row.o, row.id, row.k))
    assert sum(map(len, seen.values())) == 3000
    for rows in seen.values():
        assert [k for _, _, k in sorted(rows)] == list(range(1, len(rows) + 1))


def test_distinct_rows_on_nulls_nan_and_zero(spark):
    data = [(None, 1.0), (None, 1.0), ("a", float("nan")), ("a", float("nan")), ("a", 0.0), ("a", -0.0)]
    assert distinct_rows(spark.createDataFrame(data, "a string, b double")).count() == 3


def test_keep_equal_drops_nulls(spark):
    df = spark.createDataFrame([("x",), ("X",), (None,)], "page string")
    assert [r.page for r in keep_equal(df, "page", "x").collect()] == ["x"]


def test_projections(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert project(df, {"t": "s", "m": F.col("n") + 1}).collect() == [("a", 2)]
    assert rename_columns(df, {"n": "m"}).columns == ["m", "s"]
    assert copy_columns(df, {"k": "n"}).first().asDict() == {"n": 1, "s": "a", "k": 1}


def test_stage_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, None, datetime(2020, 1, 1))], "a int, b string, c timestamp_ntz")
    staged = stage(df)
    assert staged.dtypes == df.dtypes
    assert staged.collect() == df.collect()
    assert stage(df.limit(0)).count() == 0


def test_scratch_root_is_fresh_and_shared(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    roots = {scratch_root(spark) for _ in range(5)}
    assert len(roots) == 5
    assert all(root.startswith(shared) for root in roots)


@few_examples
@given(st.lists(st.integers(-(1 << 63), (1 << 63) - 1), min_size=1, max_size=50))
def test_epoch_ms_of_any_count(spark, values):
    most = ((1 << 63) - 1) // 1000
    df = spark.createDataFrame([(v,) for v in values], "ms bigint").select("ms", epoch_ms_to_timestamp("ms").alias("t"))
    df = add_calendar(df, "t")
    for ms, there in df.select("ms", F.col("t").isNotNull()).collect():
        assert there == (-most <= ms <= most)
    assert df.select("week", "year").count() == len(values)


class _Session:
    """Only the settings of a session."""

    def __init__(self, settings, folder=None):
        self.settings = settings
        self.conf = self.sparkContext = self
        self.getCheckpointDir = lambda: folder

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_root_refuses_a_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        scratch_root(_Session({"spark.master": "yarn"}))
    assert scratch_root(_Session({"spark.master": "local[2]"}))
    assert scratch_root(_Session({"spark.master": "yarn"}, "hdfs://h/set")).startswith("hdfs://h/set/")


def test_session(spark):
    assert create_session(conf={"spark.sql.adaptive.coalescePartitions.parallelismFirst": "true"}) is spark
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    conf = object_store_conf("group:artifact:1", "a.Provider")
    assert create_session(conf={k: v for k, v in conf.items() if k.startswith("spark.hadoop")}) is spark
    assert spark.conf.get("spark.hadoop.fs.s3a.aws.credentials.provider") == "a.Provider"
    assert conf == {
        "spark.jars.packages": "group:artifact:1",
        "spark.hadoop.fs.s3a.aws.credentials.provider": "a.Provider",
    }


@pytest.mark.parametrize("committer", COMMITTERS)
def test_object_store_committers(committer):
    conf = object_store_conf("group:artifact:1", "a.Provider", "org:cloud:2", committer)
    assert conf["spark.jars.packages"] == "group:artifact:1,org:cloud:2"
    assert conf["spark.hadoop.fs.s3a.committer.name"] == committer
    assert conf["spark.hadoop.fs.s3a.committer.magic.enabled"] == ("true" if committer == "magic" else "false")
    # both the protocol of the job and the committer of Parquet files bind to the store's
    assert conf["spark.sql.sources.commitProtocolClass"].endswith("cloud.PathOutputCommitProtocol")
    assert conf["spark.sql.parquet.output.committer.class"].endswith("cloud.BindingParquetOutputCommitter")
    factory = conf["spark.hadoop.mapreduce.outputcommitter.factory.scheme.s3a"]
    assert factory == "org.apache.hadoop.fs.s3a.commit.S3ACommitterFactory"


def test_unknown_committers_are_refused():
    with pytest.raises(ValueError):
        object_store_conf("group:artifact:1", "a.Provider", "org:cloud:2", "file")
    with pytest.raises(SystemExit):
        job.main(["preview", "out", "--s3a-cloud-module", "org:cloud:2"])
