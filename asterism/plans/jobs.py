"""The jobs: input trees to stored star schema, and back."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from asterism.functions.timeparts import epoch_ms_to_timestamp
from asterism.operators.lookup import BROADCAST_LIMIT, MOST_TASKS, JoinFigures, observed
from asterism.operators.transforms import drop_null, keep_equal
from asterism.plans.dimensions import build_artists, build_songs, build_time, build_users
from asterism.plans.fact import TITLE_ONLY, build_songplays
from asterism.sources.json_tree import BAD_LINE, dataset_path, read_json_tree, split_bad_lines, tree_fingerprint
from asterism.sources.schemas import (
    ARTISTS,
    CATALOGUE_DATASET,
    CATALOGUE_DEPTH,
    CATALOGUE_SCHEMA,
    LOG_DATASET,
    LOG_DEPTH,
    LOG_SCHEMA,
    PLAY_PAGE,
    SONGPLAYS,
    TIME,
    USERS,
    Bucket,
    songs_table,
    star_tables,
)
from asterism.sources.staging import freed, staged
from asterism.sources.tables import made_from, read_table, table_path, write_table
from asterism.sources.versions import expire_versions

# added to a dataset's name, the table of its lines that couldn't be read
BAD_LINES = "_bad_lines"


def read_catalogue(
    spark: SparkSession,
    input_root: str,
    schema: str | None = CATALOGUE_SCHEMA,
    required: Sequence[str] = (),
    bad_lines: bool = False,
) -> DataFrame:
    """The song catalogue tree, without rows that have a null in a ``required`` column."""
    return read_json_tree(spark, input_root, CATALOGUE_DATASET, CATALOGUE_DEPTH, schema, required, bad_lines)


def read_log(
    spark: SparkSession,
    input_root: str,
    schema: str | None = LOG_SCHEMA,
    required: Sequence[str] = (),
    bad_lines: bool = False,
) -> DataFrame:
    """The activity log tree, without rows that have a null in a ``required`` column."""
    return read_json_tree(spark, input_root, LOG_DATASET, LOG_DEPTH, schema, required, bad_lines)


def select_plays(log: DataFrame, page: str = PLAY_PAGE) -> DataFrame:
    """The log's play events, with their start time in place of page and epoch."""
    kept = keep_equal(log, "page", page)
    return kept.withColumn("start_time", epoch_ms_to_timestamp("ts")).drop("page", "ts")


class Ledger:
    """The tables of a job under ``output_root``, and what each was made from.

    To ``resume`` leaves out the tables that were made from the same files, by the same
    options and from the same version of other tables. The record is part of the table's
    version, so there is no other state that could be at odds with it.
    """

    def __init__(self, spark: SparkSession, output_root: str, resume: bool, *sources: Callable[[], object]):
        self.spark, self.root = spark, output_root
        # before anything is read: what changes later is another origin
        self.base = repr([source() for source in sources]) if resume else None

    def origin(self, *more: object) -> str | None:
        """Name for the job's sources and more that a table was made from."""
        if self.base is None:
            return None
        return hashlib.blake2b(repr((self.base, more)).encode(), digest_size=16).hexdigest()

    def lacks(self, name: str, *more: object) -> bool:
        """Whether the table is to be made."""
        origin = self.origin(*more)
        return origin is None or made_from(self.spark, self.root, name) != origin

    def write(
        self,
        make: Callable[[], DataFrame],
        name: str,
        keys: Sequence[str] = (),
        compact: bool = False,
        more: Sequence[object] = (),
        lookup: str | None = None,
    ) -> None:
        """Make and write a table, if it is lacking."""
        if self.lacks(name, *more):
            write_table(make(), self.root, name, keys, compact, self.origin(*more), lookup)


def run_catalogue(
    spark: SparkSession,
    input_root: str,
    output_root: str,
    song_keys: Mapping[str, str | Bucket],
    stage_inputs: bool = True,
    required: Sequence[str] = (),
    bad_lines: bool = False,
    resume: bool = False,
    by_id: bool = False,
) -> dict[str, int]:
    """Catalogue tree to the ``songs`` and ``artists`` tables.

    ``stage_inputs`` parses the JSON once into Parquet instead of once per table.
    Lines with a null in a ``required`` field, malformed ones among them, are dropped.
    With ``bad_lines`` those that couldn't be read go to the table ``song_data_bad_lines``
    instead. Returns how many ``lines`` there were, and how many of them were
    ``incomplete``, lacking a required field, and ``bad``; no job is added for that.
    With ``resume`` tables that an earlier run with ``resume`` made from the same files and
    options stay; if all do, nothing is read and there are no figures.
    ``by_id`` lays the artists out for look-ups by id, see ``write_table``.
    """
    songs = songs_table(song_keys)
    ledger = Ledger(
        spark,
        output_root,
        resume,
        lambda: tree_fingerprint(spark, input_root, CATALOGUE_DATASET, CATALOGUE_DEPTH),
        lambda: (list(required), bad_lines),
    )
    by_keys = [sorted((key, repr(of)) for key, of in song_keys.items())]
    bad_table = CATALOGUE_DATASET + BAD_LINES
    lookup = ARTISTS.lookup if by_id else None
    layout = [lookup] if lookup else []
    if not (ledger.lacks(songs.name, *by_keys) or ledger.lacks(ARTISTS.name, *layout) or bad_lines and ledger.lacks(bad_table)):
        return {}
    seen = Observation()
    lines = _watched(read_catalogue(spark, input_root, bad_lines=bad_lines), seen, required)
    with staged(lines if bad_lines else drop_null(lines, required), stage_inputs or bad_lines) as catalogue:
        if bad_lines:
            catalogue, bad = split_bad_lines(catalogue)
            ledger.write(lambda: bad, bad_table)
            catalogue = drop_null(catalogue, required)
        ledger.write(lambda: build_songs(catalogue, song_keys), songs.name, [*songs.keys], True, by_keys)
        ledger.write(lambda: build_artists(catalogue), ARTISTS.name, more=layout, lookup=lookup)
    return observed(seen)


def _watched(lines: DataFrame, seen: Observation, required: Sequence[str], **more: Column) -> DataFrame:
    """``lines``, counted as they pass by."""
    lacks = reduce(Column.__or__, (F.col(c).isNull() for c in required), F.lit(False))
    counts = {"incomplete": lacks, **more}
    if BAD_LINE in lines.columns:
        counts["bad"] = F.col(BAD_LINE).isNotNull()
    return lines.observe(seen, F.count(F.lit(1)).alias("lines"), *(F.count_if(c).alias(n) for n, c in counts.items()))


def run_log(
    spark: SparkSession,
    input_root: str,
    output_root: str,
    song_keys: Mapping[str, str | Bucket],
    page: str = PLAY_PAGE,
    on: Sequence[tuple[str, str]] = TITLE_ONLY,
    dedup_before_id: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT,
    stage_inputs: bool = True,
    compact_fact: bool = True,
    required: Sequence[str] = (),
    ordered_key: bool = False,
    most_tasks: int = MOST_TASKS,
    bad_lines: bool = False,
    resume: bool = False,
    by_id: bool = False,
) -> dict[str, int]:
    """Log tree and the stored ``songs`` to the ``users``, ``time`` and ``songplays`` tables.

    ``stage_inputs`` parses and filters the JSON once into Parquet instead of once per
    table. ``compact_fact=False`` saves the one shuffle of the fact rows when the
    songs are broadcast and the log files are large and hold one month each.
    ``ordered_key`` numbers the fact in a fixed order instead of by layout, ``required``
    drops lines with a null in one of these fields, and ``most_tasks`` bounds the tasks
    of one shuffle of the fact's join. ``bad_lines`` puts the lines that couldn't be read
    into the table ``log_data_bad_lines``.

    Returns how many ``lines`` there were, how many of them were ``incomplete``, ``bad``
    and ``plays``, and how many plays were ``unmatched``: had no song, so no row in the fact. The figures
    come out of the passes that run anyway.

    With ``resume`` tables that an earlier run with ``resume`` made from the same files,
    options and songs stay; if all do, nothing is read and there are no figures.
    ``by_id`` lays the users out for look-ups by id, see ``write_table``.
    """
    ledger = Ledger(
        spark,
        output_root,
        resume,
        lambda: tree_fingerprint(spark, input_root, LOG_DATASET, LOG_DEPTH),
        lambda: (page, list(required), bad_lines),
    )
    stored = songs_table(song_keys)
    of_fact = [table_path(spark, output_root, stored.name), [*map(tuple, on)], dedup_before_id, ordered_key]
    bad_table = LOG_DATASET + BAD_LINES
    lookup = USERS.lookup if by_id else None
    layout = [lookup] if lookup else []
    fact_lacks = ledger.lacks(SONGPLAYS.name, *of_fact)
    if not (fact_lacks or ledger.lacks(USERS.name, *layout) or ledger.lacks(TIME.name) or bad_lines and ledger.lacks(bad_table)):
        return {}
    seen, figures = Observation(), JoinFigures()
    lines = read_log(spark, input_root, bad_lines=bad_lines)
    complete = reduce(Column.__and__, (F.col(c).isNotNull() for c in required), F.lit(True))
    lines = _watched(lines, seen, required, plays=(F.col("page") == page) & complete)
    if bad_lines:
        wanted = lines.where((F.col("page") == page) | F.col(BAD_LINE).isNotNull())
    else:
        wanted = select_plays(drop_null(lines, required), page)
    with freed(spark), staged(wanted, stage_inputs or bad_lines) as plays:
        if bad_lines:
            rows, bad = split_bad_lines(plays)
            ledger.write(lambda: bad, bad_table)
            plays = select_plays(drop_null(rows, required), page)
        ledger.write(lambda: build_users(plays), USERS.name, more=layout, lookup=lookup)
        ledger.write(lambda: build_time(plays, compact=True), TIME.name, [*TIME.keys])
        if not fact_lacks:
            return observed(seen)
        songs = read_table(spark, output_root, stored.name, stored.schema)
        fact = build_songplays(
            plays,
            songs,
            on,
            dedup_before_id,
            broadcast_limit,
            compact=compact_fact,
            ordered_key=ordered_key,
            most_tasks=most_tasks,
            figures=figures,
        )
        write_table(fact, output_root, SONGPLAYS.name, [*SONGPLAYS.keys], origin=ledger.origin(*of_fact))
    return {**observed(seen), "unmatched": figures.unmatched()}


def run_star(
    spark: SparkSession,
    input_root: str,
    output_root: str,
    song_keys: Mapping[str, str | Bucket],
    stage_inputs: bool = True,
    required_song: Sequence[str] = (),
    required_log: Sequence[str] = (),
    bad_lines: bool = False,
    resume: bool = False,
    by_id: bool = False,
    **log_options,
) -> dict[str, dict[str, int]]:
    """Both jobs in order; the log job needs the stored songs. Returns the figures of both.

    With ``resume`` a run that was stopped goes on with the tables it had not finished.
    """
    log_options |= {"stage_inputs": stage_inputs, "required": required_log, "bad_lines": bad_lines, "resume": resume}
    log_options["by_id"] = by_id
    return {
        CATALOGUE_DATASET: run_catalogue(
            spark, input_root, output_root, song_keys, stage_inputs, required_song, bad_lines, resume, by_id
        ),
        LOG_DATASET: run_log(spark, input_root, output_root, song_keys, **log_options),
    }


def load_star(
    spark: SparkSession,
    output_root: str,
    song_keys: Mapping[str, str | Bucket],
    leaf_glob: bool = False,
    only: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """The stored tables by name (all five, or ``only`` some), from their roots or by leaf glob."""
    tables = {}
    for table in star_tables(song_keys):
        if only is not None and table.name not in only:
            continue
        if leaf_glob:
            tables[table.name] = read_table(spark, output_root, table.name, leaf_depth=len(table.keys))
        else:
            tables[table.name] = read_table(spark, output_root, table.name, table.schema)
    return tables


def expire_star(spark: SparkSession, output_root: str, song_keys: Mapping[str, str | Bucket], keep: int = 1) -> None:
    """Free what all but the newest ``keep`` versions of the stored tables take."""
    for table in star_tables(song_keys):
        expire_versions(spark, dataset_path(output_root, table.name), keep)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)
