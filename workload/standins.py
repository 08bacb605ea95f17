"""The given tables in the shape of the inputs: plays from ``events``, songs from
``customer`` (unique titles) or ``part`` (repeated titles)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asterism.functions.timeparts import epoch_ms_to_timestamp
from asterism.operators.lookup import BROADCAST_LIMIT, lookup_join
from asterism.operators.transforms import copy_columns, distinct_rows, project
from asterism.plans.jobs import select_plays
from asterism.sources.json_tree import dataset_path
from asterism.sources.schemas import CATALOGUE_DATASET, LOG_DATASET
from asterism.sources.staging import scratch_root, stage

PAGE = "purchase"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_ms(ts: str) -> Column:
    """Whole milliseconds from the epoch to a zone-less timestamp, in any session zone."""
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    in_minute = F.floor(F.extract(F.lit("SECOND"), F.col(ts)) * 1000)
    return F.unix_date(F.to_date(ts)).cast("bigint") * 86_400_000 + seconds * 1000 + in_minute.cast("bigint")


def log_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as activity log; the song asked for is the user's customer name."""
    return project(
        table(spark, sf_dir, "events"),
        {
            "page": "event_type",
            "song": F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")),
            "ts": epoch_ms("ts"),
            "userId": F.col("user_id").cast("string"),
            "firstName": F.concat(F.lit("F"), F.col("user_id").cast("string")),
            "lastName": F.concat(F.lit("L"), F.col("user_id").cast("string")),
            "gender": F.when(F.col("user_id") % 2 == 0, "F").otherwise("M"),
            "level": F.when(F.col("value") > 100, "paid").otherwise("free"),
            "sessionId": "event_id",
            "location": F.get_json_object("props", "$.k"),
            "userAgent": "props",
        },
    )


def plays_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_plays(log_from_events(spark, sf_dir), PAGE)


def catalogue_from_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as songs with unique titles, nations as artists."""
    nation = F.col("c_nationkey")
    return project(
        table(spark, sf_dir, "customer"),
        {
            "song_id": F.col("c_custkey").cast("string"),
            "title": "c_name",
            "artist_id": F.concat(F.lit("A"), nation.cast("string")),
            "year": nation + 1990,
            "duration": "c_acctbal",
            "artist_name": "c_mktsegment",
            "artist_location": F.when(nation < 20, F.col("c_mktsegment")),
            "artist_latitude": nation / 2,
            "artist_longitude": nation / 4 - 90,
        },
    )


def catalogue_from_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as songs whose titles repeat, brands as artists."""
    return project(
        table(spark, sf_dir, "part"),
        {
            "song_id": "p_partkey",
            "title": "p_name",
            "artist_id": "p_brand",
            "year": "p_size",
            "duration": "p_retailprice",
            "artist_name": "p_type",
            "artist_location": F.split_part("p_name", F.lit(" "), F.lit(1)),
            "artist_latitude": F.col("p_size").cast("double"),
            "artist_longitude": F.lit(None).cast("double"),
        },
    )


def fanout_inputs(
    spark: SparkSession, sf_dir: str, broadcast_limit: int = BROADCAST_LIMIT
) -> tuple[DataFrame, DataFrame]:
    """Plays asking for part names, and the distinct (name, brand) pairs as songs."""
    part = table(spark, sf_dir, "part")
    asked = plays_from_events(spark, sf_dir).drop("song").withColumn("part", F.col("location").cast("bigint"))
    names = project(part, {"p_partkey": "p_partkey", "song": "p_name"})
    plays = lookup_join(asked, names, [("part", "p_partkey")], broadcast_limit)
    songs = distinct_rows(project(part, {"title": "p_name", "song_id": "p_brand", "artist_id": "p_brand"}))
    if broadcast_limit == 0:  # both sides are read several times
        plays, songs = stage(plays), stage(songs)
    return plays, songs


def write_log_tree(spark: SparkSession, sf_dir: str) -> str:
    """Store the events as a log tree two directories deep; return its root."""
    root = scratch_root(spark)
    log = log_from_events(spark, sf_dir)
    when = epoch_ms_to_timestamp("ts")
    log = log.withColumns({"y": F.year(when), "m": F.month(when)})
    log.write.partitionBy("y", "m").json(dataset_path(root, LOG_DATASET))
    return root


def write_catalogue_tree(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """Store the customers as a catalogue tree three directories deep; return its root."""
    root = root or scratch_root(spark)
    catalogue = copy_columns(
        catalogue_from_customer(spark, sf_dir), {"k1": "artist_name", "k2": "artist_location", "k3": "artist_location"}
    )
    catalogue.write.partitionBy("k1", "k2", "k3").json(dataset_path(root, CATALOGUE_DATASET))
    return root
