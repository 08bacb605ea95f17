"""Lines that can't be read, and figures of what a job reads and drops."""

from __future__ import annotations

import json
import uuid
from pathlib import Path

import fixture_data as fx
import pytest

from asterism.operators.lookup import JoinFigures, grid_join, lookup_join
from asterism.plans.jobs import load_star, read_log, run_catalogue, run_log, run_star
from asterism.sources.json_tree import read_json_tree, split_bad_lines
from asterism.sources.schemas import LOG_SCHEMA, SONG_KEYS_YEAR_TWICE as KEYS
from asterism.sources.staging import stage
from asterism.sources.tables import read_table

PLAY = {"page": "NextSong", "song": "Alpha", "ts": 1, "userId": "1"}


def lines_of(*rows):
    return [r if isinstance(r, str) else json.dumps(r) for r in rows]


BAD = [
    "{",
    '  "page": "NextSong",',
    '  "song": "Alpha"',
    "}",
    "not json",
    '{"page": "NextSong", "ts": "soon", "userId": "9", "song": "Alpha"}',  # one value only
    "[1, 2]",
]
GOOD = lines_of(PLAY, PLAY | {"song": "Nobody knows"}, PLAY | {"song": None}, {"page": "Home"}, {}, {"page": None})


@pytest.fixture
def tree(root):
    fx.write_lines(Path(root) / "log_data/1/1/a.json", GOOD)
    fx.write_lines(Path(root) / "log_data/1/2/b.json", BAD)
    song = {"song_id": "S1", "title": "Alpha", "artist_id": "A1", "year": 1}
    fx.write_lines(Path(root) / "song_data/A/A/A/1.json", lines_of(song, song, "{oops", {"title": "no id"}))
    return root


@pytest.mark.parametrize("schema", [LOG_SCHEMA, None])
def test_rows_and_bad_lines_add_up(spark, tree, schema):
    lines = stage(read_json_tree(spark, tree, "log_data", 2, schema, bad_lines=True))
    rows, bad = split_bad_lines(lines)
    found = bad.collect()
    assert sorted(r["line"] for r in found if not r["kept"]) == sorted(line for line in BAD if "soon" not in line)
    assert rows.count() + sum(not r["kept"] for r in found) == len(GOOD) + len(BAD)
    assert {r["file"].rsplit("/", 1)[1] for r in found} == {"b.json"} and {r["block"] for r in found} == {0}
    if schema:
        assert [r["line"] for r in found if r["kept"]] == [line for line in BAD if "soon" in line]
        assert rows.columns == read_log(spark, tree).columns


def test_inferred_schema_without_bad_lines(spark, root):
    fx.write_lines(Path(root) / "log_data/1/1/a.json", GOOD)
    rows, bad = split_bad_lines(stage(read_json_tree(spark, root, "log_data", 2, bad_lines=True)))
    assert bad.count() == 0 and rows.count() == len(GOOD)


@pytest.mark.parametrize("limit", [0, 1 << 26])
@pytest.mark.parametrize("bad_lines", [False, True])
def test_figures_of_a_job(spark, tree, root, limit, bad_lines):
    figures = run_star(spark, tree, root + "/out", KEYS, broadcast_limit=limit, bad_lines=bad_lines)
    log, songs = figures["log_data"], figures["song_data"]
    assert log["lines"] == len(GOOD) + len(BAD) and songs["lines"] == 4
    assert log["plays"] == 4 and log["unmatched"] == 2 and log["incomplete"] == 0
    star = load_star(spark, root + "/out", KEYS)
    assert star["songplays"].count() == 2
    assert log.get("bad") == (len(BAD) if bad_lines else None)
    if bad_lines:
        assert read_table(spark, root + "/out", "log_data_bad_lines").count() == len(BAD)
        assert [r["line"] for r in read_table(spark, root + "/out", "song_data_bad_lines").collect()] == ["{oops"]
        assert star["songs"].count() == 2  # the unreadable line is no row of nulls
    else:
        assert star["songs"].count() == 3


@pytest.mark.parametrize("staged", [False, True])
def test_incomplete_lines_are_counted(spark, tree, root, staged):
    out = root + "/out"
    songs = run_catalogue(spark, tree, out, KEYS, stage_inputs=staged, required=["song_id"])
    assert songs == {"lines": 4, "incomplete": 2}
    log = run_log(spark, tree, out, KEYS, stage_inputs=staged, required=["ts"], bad_lines=staged)
    assert (log["lines"], log["plays"], log["unmatched"]) == (len(GOOD) + len(BAD), 3, 2)


def test_a_good_tree_and_reruns_give_the_fixture(spark, root):
    fx.write_inputs(root + "/in")
    first = run_star(spark, root + "/in", root + "/a", KEYS, bad_lines=True)
    second = run_star(spark, root + "/in", root + "/b", KEYS)
    assert first["log_data"].pop("bad") == first["song_data"].pop("bad") == 0
    assert first == second
    a, b = (load_star(spark, f"{root}/{name}", KEYS) for name in "ab")
    for name in a:
        left, right = (t[name].drop("songplay_id") for t in (a, b))
        assert left.exceptAll(right).count() == right.exceptAll(left).count() == 0


@pytest.mark.parametrize("join", [grid_join, lookup_join])
def test_unmatched_rows_of_a_join(spark, join):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,), (None,)], "k string")
    lookup = spark.createDataFrame([("a",), ("a",), ("d",), (None,)], "l string")
    figures = JoinFigures()
    assert join(rows, lookup, [("k", "l")], figures=figures).count() == 4
    assert figures.unmatched() == 4


def count_jobs(spark, action):
    group = f"jobs-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_figures_add_no_job(spark):
    rows = spark.range(1000).withColumnRenamed("id", "k")
    lookup = spark.range(10).withColumnRenamed("id", "l")
    plain = count_jobs(spark, lambda: lookup_join(rows, lookup, [("k", "l")]).write.format("noop").mode("overwrite").save())
    figures = JoinFigures()
    watched = count_jobs(
        spark, lambda: lookup_join(rows, lookup, [("k", "l")], figures=figures).write.format("noop").mode("overwrite").save()
    )
    assert watched == plain > 0
    assert figures.unmatched() == 990
