"""A small invented catalogue and log, and the tables that must come of them."""

from __future__ import annotations

import json
from datetime import datetime
from pathlib import Path

# The field names of the two inputs.
CATALOGUE_FIELDS = (
    "song_id",
    "title",
    "artist_id",
    "year",
    "duration",
    "artist_name",
    "artist_location",
    "artist_latitude",
    "artist_longitude",
)
S1 = ("S1", "Alpha", "A1", 2000, 100.5, "N1", "", None, None)
CATALOGUE = {
    "song_data/A/A/A/1.json": [S1],
    "song_data/A/B/C/2.json": [("S2", "Alpha", "A2", 0, 99.0, "N2", "X", 1.5, -2.5)],
    "song_data/A/B/D/3.json": [("S3", "Beta", "A1", 2000, 100.0, "N1 feat", "", None, None), S1],
    # too shallow to be read
    "song_data/shallow/9.json": [("S9", "Zed", "A9", 1, 1.0, "N9", "", None, None)],
}

LOG_FIELDS = (
    "page",
    "song",
    "ts",
    "userId",
    "firstName",
    "lastName",
    "gender",
    "level",
    "sessionId",
    "location",
    "userAgent",
)
ANN_FREE = ("1", "Ann", "Lee", "F", "free", 5, "L1", "UA1")
ANN_PAID = ("1", "Ann", "Lee", "F", "paid", 5, "L1", "UA1")
BO = ("2", "Bo", "Ray", "M", "free", 6, "L2", "UA2")
CY = ("3", "Cy", "Fox", "M", "free", 7, "L3", "UA3")
LOG = {
    "log_data/2018/11/a.json": [
        ("NextSong", "Alpha", 1541106106796, *ANN_FREE),  # two songs have this title
        ("NextSong", "Alpha", 1541106106796, *ANN_FREE),  # the same line again
        ("Home", None, 1541106106797, *ANN_FREE),  # not a play
        ("NextSong", "alpha", 1541106106798, *ANN_PAID),  # wrong case, changed level
        (None, "Beta", 1541106106799, *ANN_PAID),  # no page
    ],
    "log_data/2018/12/b.json": [
        ("NextSong", "Beta", 1546300799999, *BO),  # last millisecond of the year, ISO week 1
        ("NextSong", None, 1546300800000, *BO),  # no song
        ("NextSong", "Beta", 1546300800000, *BO),  # first millisecond of the year
        ("NextSong", "Gone", 1546300800001, *CY),  # not in the catalogue
    ],
}


def write_lines(path: Path, lines) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"{line}\n" for line in lines))


def write_inputs(root: str) -> str:
    for files, fields in ((CATALOGUE, CATALOGUE_FIELDS), (LOG, LOG_FIELDS)):
        for name, rows in files.items():
            write_lines(Path(root) / name, (json.dumps(dict(zip(fields, row))) for row in rows))
    return root


SONGS = [
    ("S1", "Alpha", "A1", 2000, 100.5),
    ("S2", "Alpha", "A2", 0, 99.0),
    ("S3", "Beta", "A1", 2000, 100.0),
]
ARTISTS = [
    ("A1", "N1", "", None, None),
    ("A1", "N1 feat", "", None, None),
    ("A2", "N2", "X", 1.5, -2.5),
]
USERS = [
    ("1", "Ann", "Lee", "F", "free"),
    ("1", "Ann", "Lee", "F", "paid"),
    ("2", "Bo", "Ray", "M", "free"),
    ("3", "Cy", "Fox", "M", "free"),
]
T_ALPHA = datetime(2018, 11, 1, 21, 1, 46, 796000)
T_LAST = datetime(2018, 12, 31, 23, 59, 59, 999000)
T_FIRST = datetime(2019, 1, 1)
TIME = [
    (T_ALPHA, 21, 1, 44, 11, 2018, 5),
    (T_ALPHA.replace(microsecond=798000), 21, 1, 44, 11, 2018, 5),
    (T_LAST, 23, 31, 1, 12, 2018, 2),
    (T_FIRST, 0, 1, 1, 1, 2019, 3),
    (T_FIRST.replace(microsecond=1000), 0, 1, 1, 1, 2019, 3),
]
# without the key: start_time, user_id, level, song_id, artist_id, session_id, location, user_agent, year, month
ALPHA_PLAYS = [
    (T_ALPHA, "1", "free", "S1", "A1", 5, "L1", "UA1", 2018, 11),
    (T_ALPHA, "1", "free", "S2", "A2", 5, "L1", "UA1", 2018, 11),
]
BETA_PLAYS = [
    (T_LAST, "2", "free", "S3", "A1", 6, "L2", "UA2", 2018, 12),
    (T_FIRST, "2", "free", "S3", "A1", 6, "L2", "UA2", 2019, 1),
]
SONGPLAYS = ALPHA_PLAYS * 2 + BETA_PLAYS
SONGPLAYS_DEDUPED = ALPHA_PLAYS + BETA_PLAYS
