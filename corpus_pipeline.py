"""The corpus pipeline: quality, near duplicates, personal data, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loomgraph.functions.staging import owned, release
from loomgraph.llm import bpe, mixing, near, pii, quality
from loomgraph.llm.shared import column, stage


def _stage(name: str, before: str | None):
    """A stage owns the tables that its operator writes. They go when the next stage is called, as its result has been
    written by then; only tables that docs itself still reads stay."""

    def wrap(function):
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            if before:
                release(spark, f"pipeline {before}", docs)
            with owned(f"pipeline {name}"):
                return function(spark, docs, sf_dir)

        run_stage.__doc__ = function.__doc__
        return run_stage

    return wrap


@_stage("quality", None)
def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; those that it rejects go, null and empty texts among them.

    Rows that repeat are judged alike; without any trusted document all with a text stay; an empty table stays empty.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_stage("near duplicates", "quality")
def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest key, of equals the first read.

    Texts without a word, null ones too, are nobody's duplicates and stay; an empty table stays empty.
    """
    return near.keep_firsts(docs)


@_stage("personal data", "near duplicates")
def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates in place of personal data. Every row stays, whatever its text; n_chars follows the text (null for null)."""
    from pyspark.sql import functions as F

    return pii.replace(docs).withColumn("n_chars", F.length("text").cast("long")).select(*map(column, docs.columns))


@_stage("mixing", "personal data")
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; null texts have size 0, a null source is a source of its own."""
    return mixing.mix(docs)


@_stage("byte-level BPE", "mixing")
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the mix, with the digests of ids and of the decoded bytes; a null text has no ids."""
    return bpe.encode(docs, ranks_path=public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern=public_tokenizers.PATTERN, keep_bytes=False)


STAGES = [("quality", good), ("near duplicates", distinct), ("personal data", private), ("mixing", mixed), ("byte-level BPE", encoded)]

#: No stage but mixing can be said in SQL; tests hold the others against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
