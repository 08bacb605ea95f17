"""The jobs on the invented fixture: exact tables, layouts, reruns and bad input."""

from __future__ import annotations

import json
import re
from pathlib import Path

import fixture_data as fx
import job
import pytest

from asterism.plans.jobs import (
    load_star,
    preview,
    read_catalogue,
    read_log,
    run_catalogue,
    run_log,
    run_star,
    select_plays,
)
from asterism.sources.json_tree import read_json_tree
from asterism.sources.schemas import (
    CATALOGUE_SCHEMA,
    SONG_KEYS_YEAR_ARTIST,
    SONG_KEYS_YEAR_BUCKET,
    SONG_KEYS_YEAR_TWICE,
)
from asterism.sources.staging import staged
from asterism.sources.tables import read_table, table_path

KEYS = SONG_KEYS_YEAR_TWICE


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def same(df, expected, *columns):
    assert rows(df, *columns) == sorted(expected, key=repr)


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    source = fx.write_inputs(str(tmp_path_factory.mktemp("in")))
    output = str(tmp_path_factory.mktemp("out"))
    run_star(spark, source, output, KEYS)
    return source, output, load_star(spark, output, KEYS)


def test_scans_read_the_fixed_depth_only(spark, star):
    source, _, _ = star
    assert read_catalogue(spark, source).count() == 4
    assert read_log(spark, source).count() == 9
    everything = read_json_tree(spark, source, "song_data", None, CATALOGUE_SCHEMA)
    assert everything.count() == 5


def test_songs(star):
    same(star[2]["songs"], [(*song, song[3], song[3]) for song in fx.SONGS])


def test_artists(star):
    same(star[2]["artists"], fx.ARTISTS)


def test_users(star):
    same(star[2]["users"], fx.USERS)


def test_time(star):
    same(star[2]["time"], [(*t, t[5], t[4]) for t in fx.TIME])


def test_songplays(star):
    fact = star[2]["songplays"]
    assert fact.columns[0] == "songplay_id"
    same(fact.drop("songplay_id"), fx.SONGPLAYS)
    assert fact.select("songplay_id").distinct().count() == len(fx.SONGPLAYS)


def test_leaf_glob_loses_the_keys(spark, star):
    _, output, by_root = star
    by_leaf = load_star(spark, output, KEYS, leaf_glob=True)
    for name, df in by_root.items():
        kept = [c for c in df.columns if not c.endswith("_partition")]
        assert by_leaf[name].columns == kept
        same(by_leaf[name], rows(df, *kept))


def test_preview(star):
    for df in star[2].values():
        assert preview(df, 2).count() == 2
        assert preview(df).count() == min(10, df.count())


def test_directories_are_the_key_values(star):
    _, output, _ = star
    found = {re.sub("_versions/[^/]*/", "", str(p.parent.relative_to(output))) for p in Path(output).glob("*/*/*/*=*/*=*/*.parquet")}
    assert found == {
        "songs/year_partition=0/artist_id_partition=0",
        "songs/year_partition=2000/artist_id_partition=2000",
        "time/year_partition=2018/month_partition=11",
        "time/year_partition=2018/month_partition=12",
        "time/year_partition=2019/month_partition=1",
        "songplays/year_partition=2018/month_partition=11",
        "songplays/year_partition=2018/month_partition=12",
        "songplays/year_partition=2019/month_partition=1",
    }


def test_artist_directories(spark, star, root):
    run_catalogue(spark, star[0], root, SONG_KEYS_YEAR_ARTIST)
    songs = load_star(spark, root, SONG_KEYS_YEAR_ARTIST, only=["songs"])["songs"]
    same(songs, [(*song, song[3], song[2]) for song in fx.SONGS])
    assert (Path(table_path(spark, root, "songs")) / "year_partition=2000/artist_id_partition=A1").is_dir()


@pytest.mark.parametrize(
    "options",
    [
        {"stage_inputs": False},
        {"compact_fact": False},
        {"ordered_key": True},
        {"broadcast_limit": 0, "most_tasks": 3},
        {"broadcast_limit": 0},
        {"broadcast_limit": 0, "stage_inputs": False, "compact_fact": False},
    ],
    ids=str,
)
def test_physical_options_do_not_change_the_tables(spark, star, root, options):
    run_star(spark, star[0], root, KEYS, **options)
    tables = load_star(spark, root, KEYS)
    for name, df in star[2].items():
        same(tables[name].drop("songplay_id"), rows(df.drop("songplay_id")))


def test_dedup_before_id(spark, star, root):
    run_star(spark, star[0], root, KEYS, dedup_before_id=True)
    fact = load_star(spark, root, KEYS)["songplays"]
    same(fact.drop("songplay_id"), fx.SONGPLAYS_DEDUPED)
    assert fact.select("songplay_id").distinct().count() == len(fx.SONGPLAYS_DEDUPED)


def test_join_on_further_columns(spark, star, root):
    run_catalogue(spark, star[0], root, KEYS)
    run_log(spark, star[0], root, KEYS, on=[("song", "title"), ("level", "song_id")])
    assert load_star(spark, root, KEYS)["songplays"].count() == 0


def test_rerun_replaces(spark, star, root):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        run_star(spark, star[0], root, KEYS)
        smaller = Path(root) / "in2"
        fx.write_inputs(str(smaller))
        (smaller / "log_data/2018/12/b.json").write_text("")
        run_star(spark, str(smaller), root, KEYS)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    same(load_star(spark, root, KEYS)["songplays"].drop("songplay_id"), fx.ALPHA_PLAYS * 2)
    assert not list(Path(table_path(spark, root, "songplays")).glob("year_partition=2019*"))
    # the first run's files stay until they are expired
    assert list(Path(root).glob("songplays/*/*/year_partition=2019*"))
    job.main(["expire", root])
    assert not list(Path(root).glob("songplays/*/*/year_partition=2019*"))
    same(load_star(spark, root, KEYS)["songplays"].drop("songplay_id"), fx.ALPHA_PLAYS * 2)


def test_no_plays_gives_empty_tables(spark, star, root):
    run_star(spark, star[0], root, KEYS, page="NoSuchPage")
    tables = load_star(spark, root, KEYS)
    assert {name: df.count() for name, df in tables.items()} == {
        "songs": 3,
        "artists": 3,
        "users": 0,
        "time": 0,
        "songplays": 0,
    }


def test_other_page(spark, star):
    kept = select_plays(read_log(spark, star[0]), "Home")
    assert [r.start_time.microsecond for r in kept.collect()] == [797000]


def test_staged_inputs_are_freed(spark, star, root):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    run_star(spark, star[0], root, KEYS)
    run_star(spark, star[0], root, KEYS, ordered_key=True, broadcast_limit=0)
    left = set(shared.iterdir()) - before
    assert len(left) > 4  # catalogue and plays twice, and more
    assert all(spark.read.parquet(str(path)).count() == 0 for path in left)


def test_command_line(spark, star, root, capsys):
    job.main(["build", star[0], root, "--dedup-before-id", "--song-folders", "artist"])
    stored = load_star(spark, root, SONG_KEYS_YEAR_ARTIST)
    same(stored["songplays"].drop("songplay_id"), fx.SONGPLAYS_DEDUPED)
    job.main(["preview", root, "--song-folders", "artist", "--rows", "2"])
    shown = capsys.readouterr().out
    assert [line for line in shown.splitlines() if line in stored] == list(stored)
    assert shown.count("only showing") == 0
    with pytest.raises(SystemExit):
        job.main(["preview", root, "--s3a-connector", "group:artifact:1"])


def test_text_in_a_number_is_null(spark, root):
    fx.write_lines(Path(root) / "log_data/1/1/a.json", [json.dumps({"page": "NextSong", "ts": "soon", "userId": "9"})])
    same(select_plays(read_log(spark, root)), [("9", None)], "userId", "start_time")


def test_a_table_is_read_without_a_schema(spark, star):
    _, output, tables = star
    assert read_table(spark, output, "users").dtypes == tables["users"].dtypes


def write_song(root, name, **fields):
    fx.write_lines(Path(root) / "song_data" / name, [json.dumps(fields)])


def test_malformed_line_and_text_year(spark, root):
    write_song(root, "A/A/A/1.json", song_id="S1", year="2001")
    write_song(root, "A/A/A/2.json", song_id="S2", year="unknown")
    fx.write_lines(Path(root) / "song_data/A/A/A/3.json", ["{not json"])
    declared = read_catalogue(spark, root)
    same(declared, [("S1", None), ("S2", None), (None, None)], "song_id", "year")
    inferred = read_catalogue(spark, root, schema=None)
    assert dict(inferred.dtypes)["year"] == "string"
    assert "_corrupt_record" in inferred.columns
    required = read_json_tree(spark, root, "song_data", 3, CATALOGUE_SCHEMA, required=["song_id"])
    same(required, [("S1",), ("S2",)], "song_id")


def test_null_key_has_a_directory(spark, root):
    write_song(root, "in/A/A/1.json", song_id="S1", title="T", artist_id="A")
    write_song(root, "in/A/A/2.json", song_id="S2", title="U", artist_id="A", year=1)
    run_catalogue(spark, root, root + "/out", KEYS)
    assert Path(table_path(spark, root + "/out", "songs"), "year_partition=__HIVE_DEFAULT_PARTITION__").is_dir()
    songs = load_star(spark, root + "/out", KEYS, only=["songs"])["songs"]
    same(songs, [("S1", None), ("S2", 1)], "song_id", "year_partition")


def test_strays_at_any_depth_are_not_read(spark, star, root):
    source = fx.write_inputs(root + "/in %20 put")
    for name in ("song_data/9.json", "song_data/A/9.json", "song_data/A/B/9.json", "song_data/A/B/C/D/9.json"):
        write_song(source, name.removeprefix("song_data/"), song_id="stray")
    for name in ("9.json", "2018/9.json", "2018/11/x/9.json"):
        fx.write_lines(Path(source) / "log_data" / name, [json.dumps({"page": "NextSong", "song": "Alpha", "ts": 1})])
    run_star(spark, source, root + "/out", KEYS)
    tables = load_star(spark, root + "/out", KEYS)
    for name, df in star[2].items():
        same(tables[name].drop("songplay_id"), rows(df.drop("songplay_id")))


def test_directories_that_look_like_keys(spark, root):
    write_song(root, "a=1/b=2/c=3/1.json", song_id="S1")
    write_song(root, "a=1/b=2/2.json", song_id="S2")
    same(read_catalogue(spark, root), [("S1",)], "song_id")


def test_a_line_without_a_time_does_not_end_the_job(spark, root):
    write_song(root + "/in", "A/A/A/1.json", song_id="S1", title="T", artist_id="A", year=1)
    line = {"page": "NextSong", "song": "T", "userId": "1", "sessionId": 1}
    stamps = [(1 << 63) - 1, -(1 << 63), 1541106106796000000, 1541106106796]
    fx.write_lines(Path(root) / "in/log_data/1/1/a.json", [json.dumps(line | {"ts": ts}) for ts in stamps])
    run_star(spark, root + "/in", root + "/out", KEYS)
    fact = load_star(spark, root + "/out", KEYS)["songplays"]
    assert fact.count() == 4
    same(fact.where("start_time is null"), [("S1", None, None)] * 3, "song_id", "year_partition", "month_partition")


def test_required_fields(spark, root):
    write_song(root + "/in", "A/A/A/1.json", song_id="S1", title="T", artist_id="A", year=1)
    fx.write_lines(Path(root) / "in/song_data/A/A/A/2.json", ["{not json"])
    fx.write_lines(Path(root) / "in/log_data/1/1/a.json", ["{", json.dumps({"page": "NextSong", "userId": "1", "ts": 5})])
    job.main(["build", root + "/in", root + "/out", "--drop-null-keys", "--song-folders", "bucket"])
    tables = load_star(spark, root + "/out", SONG_KEYS_YEAR_BUCKET)
    assert [tables[n].count() for n in ("songs", "artists", "users")] == [1, 1, 1]


def test_ordered_keys_are_the_same_in_every_run(spark, star, root):
    found = []
    for name in ("a", "b"):
        run_star(spark, star[0], f"{root}/{name}", KEYS, ordered_key=True)
        found.append(rows(load_star(spark, f"{root}/{name}", KEYS)["songplays"]))
    assert found[0] == found[1]
    assert sorted(r[0] for r in found[0]) == [*range(1, len(fx.SONGPLAYS) + 1)]


def test_the_first_error_is_kept(spark):
    with pytest.raises(KeyError, match="mine"), staged(spark.range(3)):
        raise KeyError("mine")


def test_hidden_files_are_skipped(spark, root):
    write_song(root, "A/A/A/1.json", song_id="S1")
    write_song(root, "A/A/A/_2.json", song_id="S2")
    write_song(root, "A/A/A/.3.json", song_id="S3")
    write_song(root, "A/A/A/4.txt", song_id="S4")
    write_song(root, "A/A/A/A/5.json", song_id="S5")
    same(read_catalogue(spark, root), [("S1",)], "song_id")
