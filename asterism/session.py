"""Session construction."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Adaptive execution coalesces small shuffle partitions, and splits skewed ones in
# the REBALANCE exchange that lays out partitioned tables. Coalescing goes by the
# advisory size and not by the number of cores, so that a wide cluster does not
# write a small dimension as thousands of tiny files.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


# How tasks hand in their files on an object store. The plain committer renames them, which
# there copies every byte, one file after the other, and isn't atomic. These upload in
# parts and complete the uploads when the job commits.
COMMITTERS = ("magic", "directory", "partitioned")


def committer_conf(committer: str = "magic") -> dict[str, str]:
    """Settings that make writes to ``s3a://`` roots commit without renames.

    They name classes of Spark's ``spark-hadoop-cloud`` module, which must be on the class
    path: without it no Parquet file can be written at all, wherever it goes. Other
    file systems keep their committer. ``magic`` needs no disk beside the store;
    ``directory`` and ``partitioned`` stage the files of a task on local disks and need a
    cluster file system for their manifests. A table is always written to a fresh folder, so the
    committers' rules for folders that exist never matter.
    """
    if committer not in COMMITTERS:
        raise ValueError(f"committer must be one of {COMMITTERS}")
    return {
        "spark.hadoop.fs.s3a.committer.name": committer,
        "spark.hadoop.fs.s3a.committer.magic.enabled": str(committer == "magic").lower(),
        "spark.hadoop.mapreduce.outputcommitter.factory.scheme.s3a": "org.apache.hadoop.fs.s3a.commit.S3ACommitterFactory",
        "spark.sql.sources.commitProtocolClass": "org.apache.spark.internal.io.cloud.PathOutputCommitProtocol",
        "spark.sql.parquet.output.committer.class": "org.apache.spark.internal.io.cloud.BindingParquetOutputCommitter",
    }


def object_store_conf(
    connector: str, credentials_provider: str, cloud_module: str | None = None, committer: str = "magic"
) -> dict[str, str]:
    """Settings that let ``s3a://`` roots be read and written.

    ``connector`` is the Maven coordinate of the Hadoop S3A module matching the
    cluster's Hadoop version; ``credentials_provider`` is a provider class name.
    ``cloud_module`` is the coordinate of ``spark-hadoop-cloud`` for the cluster's Spark
    and Scala; with it writes commit as ``committer_conf`` says, without it by renames,
    which copy every file.
    """
    conf = {
        "spark.jars.packages": ",".join(filter(None, [connector, cloud_module])),
        "spark.hadoop.fs.s3a.aws.credentials.provider": credentials_provider,
    }
    return conf | (committer_conf(committer) if cloud_module else {})


def create_session(app_name: str = "asterism", conf: Mapping[str, str] | None = None) -> SparkSession:
    """Get or create a session with adaptive execution on.

    Master, memory and parallelism belong to the cluster and are not set here;
    ``conf`` entries (for instance ``object_store_conf``) override the defaults.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**ADAPTIVE, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
