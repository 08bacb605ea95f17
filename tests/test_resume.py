"""A run that was stopped goes on with the tables it had not finished."""

from __future__ import annotations

import json
import os
from pathlib import Path

import fixture_data as fx
import pytest

from asterism.plans import jobs
from asterism.plans.jobs import expire_star, load_star, run_star
from asterism.sources.json_tree import tree_fingerprint
from asterism.sources.schemas import SONG_KEYS_YEAR_ARTIST, SONG_KEYS_YEAR_TWICE as KEYS
from asterism.sources.tables import made_from

FIVE = {"songs", "artists", "users", "time", "songplays"}
SONG = {"song_id": "S1", "title": "Alpha", "artist_id": "A1", "year": 1, "artist_name": "One"}
PLAY = {"page": "NextSong", "song": "Alpha", "ts": 1, "userId": "1"}


@pytest.fixture
def tree(root):
    fx.write_lines(Path(root) / "in/log_data/1/1/a.json", [json.dumps(PLAY), json.dumps(PLAY | {"ts": 2}), "bad"])
    fx.write_lines(Path(root) / "in/song_data/A/A/A/1.json", [json.dumps(SONG)])
    return root + "/in"


@pytest.fixture
def written(monkeypatch):
    """Names of the tables that are written."""
    names = []
    write = jobs.write_table
    monkeypatch.setattr(jobs, "write_table", lambda df, root, name, *a, **k: (write(df, root, name, *a, **k), names.append(name))[0])
    return names


def rows(spark, out):
    return {n: sorted(map(str, df.drop("songplay_id").collect())) for n, df in load_star(spark, out, KEYS).items()}


def test_a_stopped_run_redoes_only_the_fact(spark, tree, root, written, monkeypatch):
    out = root + "/out"
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "build_songplays", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_star(spark, tree, out, KEYS, resume=True)
    assert set(written) == FIVE - {"songplays"}
    written.clear()
    figures = run_star(spark, tree, out, KEYS, resume=True)
    assert written == ["songplays"]
    assert figures["song_data"] == {} and figures["log_data"]["plays"] == 2
    whole = rows(spark, out)
    run_star(spark, tree, root + "/once", KEYS)
    assert whole == rows(spark, root + "/once") and len(whole["songplays"]) == 2
    written.clear()
    assert run_star(spark, tree, out, KEYS, resume=True) == {"song_data": {}, "log_data": {}}
    assert written == []


def test_what_changed_is_redone(spark, tree, root, written):
    out = root + "/out"

    def again(**options):
        written.clear()
        run_star(spark, tree, out, options.pop("keys", KEYS), resume=True, **options)
        return set(written)

    assert again() == FIVE
    assert again() == set()
    assert again(ordered_key=True) == {"songplays"}
    assert again(page="Home") == {"users", "time", "songplays"}
    assert again() == {"users", "time", "songplays"}
    assert again(keys=SONG_KEYS_YEAR_ARTIST) == {"songs", "songplays"}  # the fact is of other songs
    assert again(required_song=["song_id"]) == {"songs", "artists", "songplays"}
    again()
    fx.write_lines(Path(tree) / "log_data/1/2/b.json", [json.dumps(PLAY | {"ts": 3})])
    assert again() == {"users", "time", "songplays"} and len(rows(spark, out)["songplays"]) == 3
    # as long as before, changed later
    song = Path(tree) / "song_data/A/A/A/1.json"
    fx.write_lines(song, [json.dumps(SONG | {"title": "Alphb"})])
    os.utime(song, (2_000_000_000, 2_000_000_000))
    assert again() == {"songs", "artists", "songplays"} and rows(spark, out)["songplays"] == []
    fx.write_lines(Path(tree) / "log_data/1/3/c.json", [json.dumps(PLAY)])
    fx.write_lines(Path(tree) / "song_data/A/A/B/2.json", [json.dumps(SONG)])
    assert again(bad_lines=True) == FIVE | {"song_data_bad_lines", "log_data_bad_lines"}
    assert again(bad_lines=True) == set()
    (Path(tree) / "log_data/1/3/c.json").unlink()
    assert again(bad_lines=True) == {"users", "time", "songplays", "log_data_bad_lines"}


def test_a_run_without_resume_does_all_and_ends_the_record(spark, tree, root, written):
    out = root + "/out"
    run_star(spark, tree, out, KEYS, resume=True)
    assert made_from(spark, out, "users")
    written.clear()
    run_star(spark, tree, out, KEYS)
    assert set(written) == FIVE and made_from(spark, out, "users") is None
    run_star(spark, tree, out, KEYS, resume=True)
    kept = made_from(spark, out, "users")
    expire_star(spark, out, KEYS)
    left = sorted(os.listdir(out + "/users/_versions"))
    assert kept and made_from(spark, out, "users") == kept and len([n for n in left if not n.startswith(".")]) == 3
    written.clear()
    run_star(spark, tree, out, KEYS, resume=True)
    assert written == []


def test_fingerprint_of_a_tree(spark, tree):
    before = tree_fingerprint(spark, tree, "log_data", 2)
    assert tree_fingerprint(spark, tree, "log_data", 2) == before
    fx.write_lines(Path(tree) / "log_data/1/1/note.txt", ["x"])
    assert tree_fingerprint(spark, tree, "log_data", 2) == before
    (Path(tree) / "log_data/2/1").mkdir(parents=True)
    (Path(tree) / "log_data/2/1/a.json").touch()  # without lines
    assert tree_fingerprint(spark, tree, "log_data", 2) == before
    fx.write_lines(Path(tree) / "log_data/2/2/a.json", [json.dumps(PLAY)])
    assert tree_fingerprint(spark, tree, "log_data", 2) != before
