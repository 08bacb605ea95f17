"""Versions of a stored table, so that a write either replaces all of it or nothing.

A table's folder holds ``_versions``: a folder of Parquet files for each write, and beside
it an empty marker of the same name, which is made last. The newest version that has a marker is
the table. The marker's name says all and it is made in one step, so this holds on object
stores too, where a rename is a copy. A write that fails leaves a folder without a marker,
which nobody reads. A reader keeps the version it began with.

A version may also have an origin, a name for what it was made from: an empty file of
the version's name and that one, made before the marker, so a finished version has it or
never had one.

A folder without ``_versions`` is a plain table, written by others or by an earlier
release, and is read as it is.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

VERSIONS, MARKER, ORIGIN = "_versions", ".done", ".from-"
# a writer may still be at work on a version without a marker
UNFINISHED_HOURS = 48.0


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _listed(spark: SparkSession, table: str) -> list:
    """What lies in a table's folder of versions; nothing if it has none."""
    fs, where = _hadoop(spark, f"{table}/{VERSIONS}")
    return list(fs.listStatus(where)) if fs.exists(where) else []


def _finished(statuses: list) -> list[str]:
    """Names of the finished versions, oldest first."""
    names = (s.getPath().getName() for s in statuses)
    return sorted(n.removesuffix(MARKER) for n in names if n.endswith(MARKER))


def current_version(spark: SparkSession, table: str) -> str:
    """Address of the files to read: the newest finished version, or the folder itself."""
    finished = _finished(_listed(spark, table))
    return f"{table}/{VERSIONS}/{finished[-1]}" if finished else table


def next_version(spark: SparkSession, table: str) -> str:
    """A fresh address for a version that will be newer than all that were begun before.

    Two writers that begin at once get two addresses; of these the later by name stays,
    the same one for every reader.
    """
    names = [s.getPath().getName() for s in _listed(spark, table)]
    numbers = [int(n.split("-")[1]) for n in names if n.startswith("v-")]
    return f"{table}/{VERSIONS}/v-{max(numbers, default=0) + 1:012d}-{uuid.uuid4().hex}"


def current_origin(spark: SparkSession, table: str) -> str | None:
    """Origin of the newest finished version, if it has one."""
    statuses = _listed(spark, table)
    names = [s.getPath().getName() for s in statuses]
    newest = [f"{name}{ORIGIN}" for name in _finished(statuses)[-1:]]
    return next((n.removeprefix(start) for start in newest for n in names if n.startswith(start)), None)


def finish_version(spark: SparkSession, version: str, origin: str | None = None) -> None:
    """Make a version whose files are all written the one that readers get."""
    if origin is not None:
        fs, where = _hadoop(spark, f"{version}{ORIGIN}{origin}")
        fs.createNewFile(where)
    fs, marker = _hadoop(spark, version + MARKER)
    if not fs.createNewFile(marker):
        raise FileExistsError(version + MARKER)


def expire_versions(
    spark: SparkSession, table: str, keep: int = 1, unfinished_hours: float = UNFINISHED_HOURS
) -> list[str]:
    """Delete all but the newest ``keep`` finished versions, and the unfinished ones not
    touched for some hours. Returns the names of the versions that went.

    A marker goes before its files, so that no reader is sent to files that are going.
    Readers that began earlier must have ended.
    """
    if keep < 1:
        raise ValueError("the current version must stay")
    statuses = _listed(spark, table)
    finished = _finished(statuses)
    stale = time.time() - unfinished_hours * 3600
    gone = finished[:-keep]
    for status in statuses:
        name = status.getPath().getName()
        if status.isDirectory() and name not in finished and status.getModificationTime() / 1000 < stale:
            gone.append(name)
    names = [s.getPath().getName() for s in statuses]
    for name in gone:
        origins = [n for n in names if n.startswith(f"{name}{ORIGIN}")]
        for file in (f"{name}{MARKER}", *origins, name):
            fs, where = _hadoop(spark, f"{table}/{VERSIONS}/{file}")
            fs.delete(where, True)
    return gone
