"""Column names and types of the input trees and the stored tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Dataset folders, their directory depth, the field names of the
# JSON inputs, and the event kept as a play.
CATALOGUE_DATASET = "song_data"
CATALOGUE_DEPTH = 3
LOG_DATASET = "log_data"
LOG_DEPTH = 2
PLAY_PAGE = "NextSong"

CATALOGUE_SCHEMA = """
    song_id STRING, title STRING, artist_id STRING, year INT, duration DOUBLE,
    artist_name STRING, artist_location STRING, artist_latitude DOUBLE, artist_longitude DOUBLE
"""

LOG_SCHEMA = """
    page STRING, song STRING, ts BIGINT, userId STRING, firstName STRING, lastName STRING,
    gender STRING, level STRING, sessionId BIGINT, location STRING, userAgent STRING
"""


@dataclass(frozen=True)
class Table:
    """A stored table: columns inside the data files, and directory keys."""

    name: str
    columns: dict[str, str]
    keys: dict[str, str] = field(default_factory=dict)
    # the id that rows are looked up by
    lookup: str | None = None

    @property
    def schema(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in {**self.columns, **self.keys}.items())


# Names, column order and directory keys of the five tables.
SONG_COLUMNS = {
    "song_id": "STRING",
    "title": "STRING",
    "artist_id": "STRING",
    "year": "INT",
    "duration": "DOUBLE",
}
ARTISTS = Table(
    "artists",
    {
        "artist_id": "STRING",
        "name": "STRING",
        "location": "STRING",
        "latitude": "DOUBLE",
        "longitude": "DOUBLE",
    },
    lookup="artist_id",
)
USERS = Table(
    "users",
    {
        "user_id": "STRING",
        "first_name": "STRING",
        "last_name": "STRING",
        "gender": "STRING",
        "level": "STRING",
    },
    lookup="user_id",
)
TIME = Table(
    "time",
    {
        "start_time": "TIMESTAMP_NTZ",
        "hour": "INT",
        "day": "INT",
        "week": "INT",
        "month": "INT",
        "year": "INT",
        "weekday": "INT",
    },
    {"year_partition": "INT", "month_partition": "INT"},
)
SONGPLAYS = Table(
    "songplays",
    {
        "songplay_id": "BIGINT",
        "start_time": "TIMESTAMP_NTZ",
        "user_id": "STRING",
        "level": "STRING",
        "song_id": "STRING",
        "artist_id": "STRING",
        "session_id": "BIGINT",
        "location": "STRING",
        "user_agent": "STRING",
    },
    {"year_partition": "INT", "month_partition": "INT"},
)


@dataclass(frozen=True)
class Bucket:
    """A directory key of bounded number: a hash of ``column``, from 0 to ``size`` - 1."""

    column: str
    size: int


# The ways to fill the directory keys of ``songs``. The first repeats the year under
# the artist's name; the second gives each artist a directory, which suits few artists
# only; the third gives them 64 buckets a year, whatever their number.
SONG_KEYS_YEAR_TWICE = {"year_partition": "year", "artist_id_partition": "year"}
SONG_KEYS_YEAR_ARTIST = {"year_partition": "year", "artist_id_partition": "artist_id"}
SONG_KEYS_YEAR_BUCKET = {"year_partition": "year", "artist_bucket": Bucket("artist_id", 64)}


def songs_table(song_keys: Mapping[str, str | Bucket]) -> Table:
    """The ``songs`` table with directory keys ``{key: source column or bucket of one}``."""
    kinds = {k: "INT" if isinstance(of, Bucket) else SONG_COLUMNS[of] for k, of in song_keys.items()}
    return Table("songs", SONG_COLUMNS, kinds)


def star_tables(song_keys: Mapping[str, str | Bucket]) -> tuple[Table, ...]:
    return (songs_table(song_keys), ARTISTS, USERS, TIME, SONGPLAYS)
