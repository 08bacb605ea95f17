"""The four dimension tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterism.functions.timeparts import CALENDAR, add_calendar
from asterism.operators.layout import rebalance
from asterism.operators.transforms import copy_columns, distinct_rows, hash_bucket, project
from asterism.sources.schemas import SONG_COLUMNS, Bucket

# Output column -> input field of each dimension.
SONG_FIELDS = {name: name for name in SONG_COLUMNS}
ARTIST_FIELDS = {
    "artist_id": "artist_id",
    "name": "artist_name",
    "location": "artist_location",
    "latitude": "artist_latitude",
    "longitude": "artist_longitude",
}
USER_FIELDS = {
    "user_id": "userId",
    "first_name": "firstName",
    "last_name": "lastName",
    "gender": "gender",
    "level": "level",
}


def build_songs(catalogue: DataFrame, song_keys: Mapping[str, str | Bucket]) -> DataFrame:
    """Distinct songs with directory keys ``{key: source column or bucket of one}``.

    The keys repeat columns, so they are added after the distinct: the same rows
    for a narrower shuffle.
    """
    return copy_columns(
        distinct_rows(project(catalogue, SONG_FIELDS)),
        {k: hash_bucket(of.column, of.size) if isinstance(of, Bucket) else of for k, of in song_keys.items()},
    )


def build_artists(catalogue: DataFrame) -> DataFrame:
    """Distinct artist rows; an artist spelled two ways is there twice."""
    return distinct_rows(project(catalogue, ARTIST_FIELDS))


def build_users(plays: DataFrame) -> DataFrame:
    """Distinct user rows; a user whose level changed is there twice."""
    return distinct_rows(project(plays, USER_FIELDS))


def build_time(plays: DataFrame, ts_col: str = "start_time", compact: bool = False) -> DataFrame:
    """Distinct start times with calendar parts and year and month keys.

    Every other column follows from the start time, so only that is made distinct
    and shuffled. ``compact`` also gathers each month for the write, while the
    rows are still three columns wide.
    """
    times = distinct_rows(project(plays, {"start_time": ts_col}))
    times = times.withColumns({"year_partition": F.year("start_time"), "month_partition": F.month("start_time")})
    if compact:
        times = rebalance(times, ["year_partition", "month_partition"])
    return add_calendar(times).select("start_time", *CALENDAR, "year_partition", "month_partition")
