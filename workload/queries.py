"""The registered queries. Each reads the given tables whole."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterism.functions.keys import add_ordered_key, add_surrogate_key
from asterism.functions.timeparts import add_calendar, epoch_ms_to_timestamp
from asterism.operators.transforms import keep_equal, project, rename_columns
from asterism.plans.dimensions import build_artists, build_songs, build_time, build_users
from asterism.plans.fact import build_songplays
from asterism.plans.jobs import load_star, preview, read_catalogue, read_log, run_catalogue, run_star
from asterism.sources.schemas import (
    ARTISTS,
    LOG_DATASET,
    SONG_KEYS_YEAR_ARTIST,
    SONG_KEYS_YEAR_BUCKET,
    SONG_KEYS_YEAR_TWICE,
    SONGPLAYS,
    TIME,
    USERS,
    songs_table,
)
from asterism.sources.json_tree import dataset_path
from asterism.sources.staging import scratch_root, stage
from asterism.sources.tables import read_table, write_table
from workload.standins import (
    PAGE,
    catalogue_from_customer,
    catalogue_from_part,
    epoch_ms,
    fanout_inputs,
    log_from_events,
    plays_from_events,
    table,
    write_catalogue_tree,
    write_log_tree,
)

Query = Callable[[SparkSession, str], DataFrame]


# -- filter, projections, distinct ------------------------------------------


def filter_events(spark: SparkSession, sf: str) -> DataFrame:
    return keep_equal(table(spark, sf, "events"), "event_type", PAGE).select("event_id", "user_id", "value")


def rename_column(spark: SparkSession, sf: str) -> DataFrame:
    return rename_columns(table(spark, sf, "part").select("p_partkey", "p_size"), {"p_size": "song_year"})


def dim_songs(spark: SparkSession, sf: str) -> DataFrame:
    return build_songs(catalogue_from_part(spark, sf), SONG_KEYS_YEAR_TWICE)


def dim_artists(spark: SparkSession, sf: str) -> DataFrame:
    return build_artists(catalogue_from_part(spark, sf))


def _order_users(spark: SparkSession, sf: str) -> DataFrame:
    """Finished orders as plays: many rows for each user and level."""
    return project(
        keep_equal(table(spark, sf, "orders"), "o_orderstatus", "F"),
        {
            "userId": F.col("o_custkey").cast("string"),
            "firstName": "o_orderstatus",
            "lastName": F.lit(None).cast("string"),
            "gender": F.when(F.col("o_custkey") % 2 == 0, "F").otherwise("M"),
            "level": "o_orderpriority",
        },
    )


def dim_users(spark: SparkSession, sf: str) -> DataFrame:
    return build_users(_order_users(spark, sf))


# -- time ---------------------------------------------------------------------


def epoch_ms_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    events = project(table(spark, sf, "events"), {"event_id": "event_id", "ms": epoch_ms("ts")})
    return events.select("event_id", epoch_ms_to_timestamp("ms").alias("start_time"))


def calendar_parts(spark: SparkSession, sf: str) -> DataFrame:
    return add_calendar(table(spark, sf, "events").select("event_id", "ts"), "ts").drop("ts")


def dim_time(spark: SparkSession, sf: str) -> DataFrame:
    return build_time(table(spark, sf, "events"), "ts")


def epoch_out_of_range(spark: SparkSession, sf: str) -> DataFrame:
    """Some epochs are nanoseconds or the largest count there is: they have no time."""
    ms = F.when(F.col("event_id") % 7 == 0, epoch_ms("ts") * 1_000_000).when(
        F.col("event_id") % 7 == 1, F.lit((1 << 63) - 1)
    )
    events = table(spark, sf, "events").select("event_id", F.coalesce(ms, epoch_ms("ts")).alias("ms"))
    return events.select("event_id", epoch_ms_to_timestamp("ms").alias("start_time"))


def dim_time_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Dates over several years: ISO weeks at year ends, leap days."""
    return build_time(table(spark, sf, "orders"), "o_orderdate")


# -- join and fact --------------------------------------------------------------


def _unkeyed(fact: DataFrame) -> DataFrame:
    """Without the key, whose values depend on the partition layout."""
    return fact.drop("songplay_id")


def fact_unique_title(spark: SparkSession, sf: str) -> DataFrame:
    return _unkeyed(build_songplays(plays_from_events(spark, sf), catalogue_from_customer(spark, sf)))


def fact_unique_title_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The shuffle join that serves a catalogue too large to broadcast."""
    plays, songs = plays_from_events(spark, sf), catalogue_from_customer(spark, sf)
    return _unkeyed(build_songplays(plays, songs, broadcast_limit=0))


def fact_title_fanout(spark: SparkSession, sf: str) -> DataFrame:
    return _unkeyed(build_songplays(*fanout_inputs(spark, sf)))


def fact_title_fanout_grid(spark: SparkSession, sf: str) -> DataFrame:
    # more tasks than titles, so that even evenly asked titles are cut up
    plays, songs = fanout_inputs(spark, sf, broadcast_limit=0)
    return _unkeyed(build_songplays(plays, songs, broadcast_limit=0, min_tasks=256))


def fact_two_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Joined on a second column as well as the title."""
    plays = plays_from_events(spark, sf).withColumn("asked_id", F.col("userId"))
    songs = catalogue_from_customer(spark, sf)
    return _unkeyed(build_songplays(plays, songs, on=[("song", "title"), ("asked_id", "song_id")]))


def fact_case_and_null(spark: SparkSession, sf: str) -> DataFrame:
    """Song texts in the wrong case or missing match nothing."""
    text = F.when(F.col("level") == "paid", F.upper("song")).when(F.col("gender") == "F", F.col("song"))
    plays = plays_from_events(spark, sf).withColumn("song", text)
    return _unkeyed(build_songplays(plays, catalogue_from_customer(spark, sf)))


def dedup_before_id(spark: SparkSession, sf: str) -> DataFrame:
    """Plays cut to their day, user and level, so that many repeat."""
    plays = plays_from_events(spark, sf).withColumns(
        {
            "start_time": F.to_date("start_time").cast("timestamp_ntz"),
            "sessionId": F.lit(0).cast("bigint"),
            "location": F.lit(None).cast("string"),
            "userAgent": F.col("gender"),
        }
    )
    return _unkeyed(build_songplays(plays, catalogue_from_customer(spark, sf), dedup_before_id=True))


def surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    fact = build_songplays(plays_from_events(spark, sf), catalogue_from_customer(spark, sf))
    return fact.agg(F.count("songplay_id").alias("n"), F.countDistinct("songplay_id").alias("n_ids"))


def surrogate_key_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Keys on a plain scan: every row has one, and none is shared."""
    keyed = add_surrogate_key(table(spark, sf, "orders").select("o_orderstatus"), "songplay_id")
    return keyed.groupBy("o_orderstatus").agg(
        F.count("songplay_id").alias("n"), F.countDistinct("songplay_id").alias("n_ids")
    )


def surrogate_key_stable(spark: SparkSession, sf: str) -> DataFrame:
    plays = keep_equal(table(spark, sf, "events"), "event_type", PAGE).select("event_id", "ts")
    return add_ordered_key(plays, "songplay_id", F.to_date("ts"), ["ts", "event_id"]).drop("ts")


# -- stored tables ---------------------------------------------------------------


def _stored_songs(spark: SparkSession, sf: str, song_keys: dict[str, str]) -> str:
    root = scratch_root(spark)
    stored = songs_table(song_keys)
    songs = build_songs(catalogue_from_customer(spark, sf), song_keys)
    write_table(songs, root, stored.name, [*stored.keys], compact=True)
    return root


def scan_songs_leaf(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, _stored_songs(spark, sf, SONG_KEYS_YEAR_TWICE), "songs", leaf_depth=2)


def scan_songs_root(spark: SparkSession, sf: str) -> DataFrame:
    root = _stored_songs(spark, sf, SONG_KEYS_YEAR_TWICE)
    return read_table(spark, root, "songs", songs_table(SONG_KEYS_YEAR_TWICE).schema)


def scan_songs_by_artist(spark: SparkSession, sf: str) -> DataFrame:
    """By bucket of the artist: a bounded number of directories for any number of artists."""
    root = _stored_songs(spark, sf, SONG_KEYS_YEAR_BUCKET)
    return read_table(spark, root, "songs", songs_table(SONG_KEYS_YEAR_BUCKET).schema)


def scan_songs_null_key(spark: SparkSession, sf: str) -> DataFrame:
    """Songs without an artist come back from the default directory with a null key."""
    root, stored = scratch_root(spark), songs_table(SONG_KEYS_YEAR_ARTIST)
    catalogue = catalogue_from_customer(spark, sf)
    catalogue = catalogue.withColumn("artist_id", F.when(F.col("artist_location").isNotNull(), F.col("artist_id")))
    write_table(build_songs(catalogue, SONG_KEYS_YEAR_ARTIST), root, stored.name, [*stored.keys], compact=True)
    return read_table(spark, root, stored.name, stored.schema)


def sink_artists(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_root(spark)
    write_table(build_artists(catalogue_from_part(spark, sf)), root, ARTISTS.name)
    return read_table(spark, root, ARTISTS.name, leaf_depth=0)


def sink_users(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_root(spark)
    write_table(build_users(_order_users(spark, sf)), root, USERS.name)
    return read_table(spark, root, USERS.name, leaf_depth=0)


def sink_artists_by_id(spark: SparkSession, sf: str) -> DataFrame:
    """Laid out for look-ups by id."""
    root = scratch_root(spark)
    write_table(build_artists(catalogue_from_part(spark, sf)), root, ARTISTS.name, lookup=ARTISTS.lookup)
    return read_table(spark, root, ARTISTS.name, ARTISTS.schema)


def sink_users_by_id(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_root(spark)
    write_table(build_users(_order_users(spark, sf)), root, USERS.name, lookup=USERS.lookup)
    return read_table(spark, root, USERS.name, USERS.schema)


def _stored_time(spark: SparkSession, sf: str) -> str:
    root = scratch_root(spark)
    times = build_time(table(spark, sf, "orders"), "o_orderdate", compact=True)
    write_table(times, root, TIME.name, [*TIME.keys])
    return root


def sink_time_by_month(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, _stored_time(spark, sf), TIME.name, TIME.schema)


def scan_time_leaf(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, _stored_time(spark, sf), TIME.name, leaf_depth=2)


def _stored_fact(spark: SparkSession, sf: str) -> str:
    root = scratch_root(spark)
    fact = build_songplays(plays_from_events(spark, sf), catalogue_from_customer(spark, sf), compact=True)
    write_table(fact, root, SONGPLAYS.name, [*SONGPLAYS.keys])
    return root


def fact_star(spark: SparkSession, sf: str) -> DataFrame:
    return _unkeyed(read_table(spark, _stored_fact(spark, sf), SONGPLAYS.name, SONGPLAYS.schema))


def scan_songplays_leaf(spark: SparkSession, sf: str) -> DataFrame:
    return _unkeyed(read_table(spark, _stored_fact(spark, sf), SONGPLAYS.name, leaf_depth=2))


def sink_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Songs from parts, then songs from customers over them: the first are gone."""
    root = scratch_root(spark)
    stored = songs_table(SONG_KEYS_YEAR_TWICE)
    for catalogue in (catalogue_from_part(spark, sf), catalogue_from_customer(spark, sf)):
        catalogue = catalogue.withColumn("song_id", F.col("song_id").cast("string"))
        write_table(build_songs(catalogue, SONG_KEYS_YEAR_TWICE), root, stored.name, [*stored.keys], compact=True)
    return read_table(spark, root, stored.name, stored.schema)


def _count_shown(df: DataFrame) -> DataFrame:
    """How many rows a preview shows, and how many of those, distinct, are in the table."""
    shown = stage(preview(df))
    different = shown.distinct().count()
    counts = [
        shown.agg(F.count(F.lit(1)).alias("n"), F.lit(0).alias("there")),
        shown.intersect(df).agg(F.lit(0).alias("n"), F.count(F.lit(1)).alias("there")),
    ]
    both = counts[0].unionAll(counts[1]).agg(F.sum("n").alias("n"), F.sum("there").alias("there"))
    return both.select("n", (F.col("there") == different).alias("all_there"))


def preview_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _count_shown(table(spark, sf, "part"))


# -- JSON trees and whole jobs ---------------------------------------------------


def scan_json_log(spark: SparkSession, sf: str) -> DataFrame:
    return read_log(spark, write_log_tree(spark, sf))


def scan_json_log_inferred(spark: SparkSession, sf: str) -> DataFrame:
    return read_log(spark, write_log_tree(spark, sf), schema=None)


def scan_json_log_strays(spark: SparkSession, sf: str) -> DataFrame:
    """The log tree with files of its lines also above and below the depth: these are not read."""
    root = write_log_tree(spark, sf)
    log = log_from_events(spark, sf).withColumn("userAgent", F.lit("stray"))
    for place in ("", "/s", "/s/t/u", "/s/t/u/v"):
        log.write.mode("append").json(dataset_path(root, LOG_DATASET) + place)
    return read_log(spark, root)


def scan_json_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    return read_catalogue(spark, write_catalogue_tree(spark, sf))


def _catalogue_table(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        output = scratch_root(spark)
        run_catalogue(spark, write_catalogue_tree(spark, sf), output, SONG_KEYS_YEAR_TWICE)
        return load_star(spark, output, SONG_KEYS_YEAR_TWICE, only=[name])[name]

    return run


def _stored_star(spark: SparkSession, sf: str, **options) -> str:
    source, output = write_log_tree(spark, sf), scratch_root(spark)
    write_catalogue_tree(spark, sf, source)
    run_star(spark, source, output, SONG_KEYS_YEAR_TWICE, page=PAGE, **options)
    return output


def _star_table(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return load_star(spark, _stored_star(spark, sf), SONG_KEYS_YEAR_TWICE, only=[name])[name].drop("songplay_id")

    return run


def star_ordered_key(spark: SparkSession, sf: str) -> DataFrame:
    """The stored fact with keys in a fixed order, which are the same in every run."""
    output = _stored_star(spark, sf, ordered_key=True)
    return load_star(spark, output, SONG_KEYS_YEAR_TWICE, only=["songplays"])["songplays"]


def star_required(spark: SparkSession, sf: str) -> DataFrame:
    """The stored users from a log in which some lines have no location; those are dropped."""
    source, output = scratch_root(spark), scratch_root(spark)
    write_catalogue_tree(spark, sf, source)
    log = log_from_events(spark, sf).withColumn("location", F.when(F.col("gender") == "F", F.col("location")))
    log.write.json(dataset_path(source, LOG_DATASET) + "/y/m")
    run_star(spark, source, output, SONG_KEYS_YEAR_TWICE, page=PAGE, required_log=["location"])
    return load_star(spark, output, SONG_KEYS_YEAR_TWICE, only=["users"])["users"]


def star_preview(spark: SparkSession, sf: str) -> DataFrame:
    """What the preview of each stored table shows."""
    star = load_star(spark, _stored_star(spark, sf), SONG_KEYS_YEAR_TWICE, leaf_glob=True)
    shown = [_count_shown(df).select(F.lit(name).alias("table_name"), "n", "all_there") for name, df in star.items()]
    return reduce(DataFrame.unionAll, shown)


QUERIES: dict[str, Query] = {
    "filter_events": filter_events,
    "rename_column": rename_column,
    "dim_songs": dim_songs,
    "dim_artists": dim_artists,
    "dim_users": dim_users,
    "epoch_ms_to_timestamp": epoch_ms_round_trip,
    "epoch_out_of_range": epoch_out_of_range,
    "calendar_parts": calendar_parts,
    "dim_time": dim_time,
    "dim_time_orders": dim_time_orders,
    "fact_unique_title": fact_unique_title,
    "fact_unique_title_grid": fact_unique_title_grid,
    "fact_title_fanout": fact_title_fanout,
    "fact_title_fanout_grid": fact_title_fanout_grid,
    "fact_two_keys": fact_two_keys,
    "fact_case_and_null": fact_case_and_null,
    "fact_star": fact_star,
    "dedup_before_id": dedup_before_id,
    "surrogate_key": surrogate_key,
    "surrogate_key_rows": surrogate_key_rows,
    "surrogate_key_stable": surrogate_key_stable,
    "scan_songs_leaf": scan_songs_leaf,
    "scan_songs_root": scan_songs_root,
    "scan_songs_by_artist": scan_songs_by_artist,
    "scan_songs_null_key": scan_songs_null_key,
    "scan_time_leaf": scan_time_leaf,
    "scan_songplays_leaf": scan_songplays_leaf,
    "sink_artists": sink_artists,
    "sink_users": sink_users,
    "sink_artists_by_id": sink_artists_by_id,
    "sink_users_by_id": sink_users_by_id,
    "sink_time_by_month": sink_time_by_month,
    "sink_overwrite": sink_overwrite,
    "scan_json_log": scan_json_log,
    "scan_json_log_inferred": scan_json_log_inferred,
    "scan_json_log_strays": scan_json_log_strays,
    "scan_json_catalogue": scan_json_catalogue,
    "preview": preview_rows,
    "star_songs": _catalogue_table("songs"),
    "star_artists": _catalogue_table("artists"),
    "star_users": _star_table("users"),
    "star_time": _star_table("time"),
    "star_songplays": _star_table("songplays"),
    "star_ordered_key": star_ordered_key,
    "star_required": star_required,
    "star_preview": star_preview,
}
