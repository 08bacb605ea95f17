"""JSON-lines trees of a fixed directory depth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asterism.operators.transforms import drop_null

# columns that a tree read with ``bad_lines`` has besides its fields
BAD_LINE, BAD_FILE, BAD_BLOCK = "_bad_line", "_bad_file", "_bad_block"
_BAD = (BAD_LINE, BAD_FILE, BAD_BLOCK)


def dataset_path(root: str, name: str) -> str:
    """Address of a dataset below any Hadoop-readable root."""
    return f"{root.rstrip('/')}/{name}"


def read_json_tree(
    spark: SparkSession,
    root: str,
    dataset: str,
    depth: int | None,
    schema: str | None = None,
    required: Sequence[str] = (),
    bad_lines: bool = False,
) -> DataFrame:
    """Read the ``*.json`` files lying exactly ``depth`` directories below a dataset.

    Files at any other depth give no rows; ``depth=None`` reads every depth.
    With a schema the scan is lazy and a bad value or line becomes null; without
    one Spark first runs a job over all the data to infer it, to which a file one
    level too high may add columns. Rows with a null in a ``required`` column are
    dropped.

    With ``bad_lines`` no row is dropped, and each line that couldn't be read as it is,
    wholly or in one value, also has its text, file and the start of its block in it, for
    ``split_bad_lines``. Stage the result: Spark can't read such lines alone.

    The tree is listed by its lowest directories and not file by file. Their glob
    also matches files one level up, so the depth is checked by the file's path.
    """
    if bad_lines and schema is not None:
        schema = f"{schema}, {BAD_LINE} STRING"
    reader = (spark.read if schema is None else spark.read.schema(schema)).option("pathGlobFilter", "*.json")
    if bad_lines:
        reader = reader.option("columnNameOfCorruptRecord", BAD_LINE)
    base = dataset_path(root, dataset)
    if depth is None:
        rows = reader.option("recursiveFileLookup", True).json(base)
    else:
        rows = reader.json("/".join([base, *["*"] * depth]))
        path = rows.metadataColumn("_metadata")["file_path"]
        rows = rows.where(_names(path) == _depth(spark, base) + depth + 1)
    return _with_places(rows) if bad_lines else drop_null(rows, required)


def tree_fingerprint(spark: SparkSession, root: str, dataset: str, depth: int) -> str:
    """A digest of names, sizes and times of change of a tree's files, whose bytes aren't read. Files
    without bytes make no difference.

    Tasks hash the files of their part of the listing, and only sums come to the driver.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
    files = files.load("/".join([dataset_path(root, dataset), *["*"] * depth]))
    file = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
    total = files.select(file.alias("file")).agg(
        F.count(F.lit(1)), F.sum(F.col("file").cast("decimal(20,0)")), F.bit_xor("file")
    )
    return "_".join(str(value) for value in total.first())


def _with_places(rows: DataFrame) -> DataFrame:
    """``rows`` with the place of each bad line. A schema that was inferred has no column for
    them if there were none."""
    place = rows.metadataColumn("_metadata")
    if BAD_LINE not in rows.columns:
        rows = rows.withColumn(BAD_LINE, F.lit(None).cast("string"))
    bad = F.col(BAD_LINE).isNotNull()
    return rows.withColumns(
        {BAD_FILE: F.when(bad, place["file_path"]), BAD_BLOCK: F.when(bad, place["file_block_start"])}
    )


def unreadable(df: DataFrame) -> Column:
    """Whether a line of a tree read with ``bad_lines`` has no value at all."""
    fields = [F.col(c) for c in df.columns if c not in _BAD]
    return F.col(BAD_LINE).isNotNull() & F.coalesce(*(f.cast("string") for f in fields)).isNull()


def split_bad_lines(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of a staged tree read with ``bad_lines``, and its bad lines.

    The second holds line, file, block and whether the line is a row too, with null for the
    value that couldn't be read. So the rows, and the bad lines that are none, are all lines.
    """
    gone = unreadable(df)
    bad = df.where(F.col(BAD_LINE).isNotNull()).select(
        F.col(BAD_LINE).alias("line"), F.col(BAD_FILE).alias("file"), F.col(BAD_BLOCK).alias("block"), (~gone).alias("kept")
    )
    return df.where(~gone).drop(*_BAD), bad


def _names(path: Column) -> Column:
    """Number of names in a qualified path."""
    local = F.regexp_replace(path, r"^[^:/]+:(//[^/]*)?", "")
    return F.size(F.filter(F.split(local, "/"), lambda name: name != ""))


def _depth(spark: SparkSession, path: str) -> int:
    """Number of names in the qualified form of a path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).depth()
