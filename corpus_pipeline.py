"""From raw documents to token files: each stage works on all that the one before kept.

``STAGES`` are functions of (spark, docs, sf_dir). All but the last return rows with
the columns of ``documents``; the last returns the documents of the token files.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from asterism.llm import decontaminate, jaccard_join, mixing, quality_cnn, token_files
from asterism.llm.common import read, share_package
from asterism.sources.staging import freed, scratch_root, stage

# near copies of the second stage: words of an n-gram, and percent of their union that two sets share
NEAR_NGRAM, NEAR_PERCENT = 5, 80


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality_cnn.good_documents(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the n-gram Jaccard join links."""
    share_package(spark)
    return jaccard_join.distinct_documents(docs, NEAR_PERCENT, NEAR_NGRAM)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the token files, read back from them."""
    share_package(spark)
    root = scratch_root(spark)
    token_files.write_token_files(docs, root, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_token_files(spark, root)


STAGES = [
    ("quality classifier", drop_poor),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("source mix", mix_sources),
    ("token files", token_output),
]

# a trained network, edit distances and a tokenizer are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next.

    What a stage stages on its way is freed when its result is written.
    """
    docs = read(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        with freed(spark):
            docs = stage(function(spark, docs, sf_dir), scratch_root(spark))
    return STAGES[-1][1](spark, docs, sf_dir)
