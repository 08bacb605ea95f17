"""The whole job on random inputs, against plain Python."""

from __future__ import annotations

import json
import random
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from fixture_data import CATALOGUE_FIELDS, LOG_FIELDS, write_lines

from asterism.plans.jobs import load_star, run_star
from asterism.sources.schemas import SONG_KEYS_YEAR_ARTIST

TITLES = ["Hot", "hot", "", "Été", "a b", "100%", "=x/y", None]


def inputs(rnd):
    """Few distinct values, so that rows repeat; one title is asked for half of the time."""
    songs = [
        (
            rnd.choice(["S1", "S2", "S3", None]),
            rnd.choice(TITLES),
            rnd.choice(["A1", "A 2", "A/3", None]),
            rnd.choice([0, 1999, None]),
            rnd.choice([1.5, None]),
            rnd.choice(["N", None]),
            rnd.choice(["", "L"]),
            rnd.choice([-1.25, None]),
            rnd.choice([0.5, None]),
        )
        for _ in range(rnd.randrange(40))
    ]
    plays = [
        (
            rnd.choice(["NextSong", "NextSong", "Home", None]),
            "Hot" if rnd.random() < 0.5 else rnd.choice(TITLES),
            rnd.choice([0, 951782399999, 951782400000, 1709251199999, 1735689600000]),
            rnd.choice(["1", "2", None]),
            "F",
            "L",
            rnd.choice(["F", "M"]),
            rnd.choice(["free", "paid"]),
            rnd.choice([1, 2, None]),
            "Loc",
            rnd.choice(["UA", None]),
        )
        for _ in range(rnd.randrange(150))
    ]
    return songs, plays


def write(root, dataset, depth, fields, rows, rnd):
    for n, part in enumerate([rows[::2], rows[1::2]]):
        folders = "/".join(rnd.choice("AB") for _ in range(depth))
        lines = (json.dumps(dict(zip(fields, row))) for row in part)
        write_lines(Path(root) / dataset / folders / f"{n}.json", lines)


def expected(songs, plays, dedup):
    song_rows = {row[:5] for row in songs}
    kept = [(p, datetime(1970, 1, 1) + timedelta(milliseconds=p[2])) for p in plays if p[0] == "NextSong"]
    fact = Counter(
        (t, p[3], p[7], s[0], s[2], p[8], p[9], p[10], t.year, t.month)
        for p, t in kept
        for s in song_rows
        if p[1] is not None and p[1] == s[1]
    )
    return {
        "songs": Counter((*s, s[3], s[2]) for s in song_rows),
        "artists": Counter({(s[2], *s[5:]) for s in songs}),
        "users": Counter({p[3:8] for p, _ in kept}),
        "time": Counter(
            {
                (t, t.hour, t.day, t.isocalendar().week, t.month, t.year, t.isoweekday() % 7 + 1, t.year, t.month)
                for _, t in kept
            }
        ),
        "songplays": Counter(set(fact)) if dedup else fact,
    }


@pytest.mark.parametrize("seed", range(6))
def test_star_of_random_inputs(spark, root, seed):
    rnd = random.Random(seed)
    songs, plays = inputs(rnd)
    write(root, "in/song_data", 3, CATALOGUE_FIELDS, songs, rnd)
    write(root, "in/log_data", 2, LOG_FIELDS, plays, rnd)
    dedup = seed % 2 == 1
    options = {"dedup_before_id": dedup, "broadcast_limit": (1 << 20, 0, 800)[seed % 3]}
    run_star(spark, root + "/in", root + "/out", SONG_KEYS_YEAR_ARTIST, **options)
    want = expected(songs, plays, dedup)
    for name, df in load_star(spark, root + "/out", SONG_KEYS_YEAR_ARTIST).items():
        assert Counter(tuple(r) for r in df.drop("songplay_id").collect()) == want[name], name
