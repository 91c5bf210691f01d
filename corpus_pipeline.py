"""The corpus pipeline: quality filter, exact dedup, near-dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskline.llm import chunk_dedup, exact_dedup, packing, quality, simhash
from maskline.llm.storage import Workspace


def _of(work: Workspace, result: DataFrame) -> DataFrame:
    """A stage's result, with the workspace that it reads from; run() closes that once the result is written."""
    result._workspace = work
    return result


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    work = Workspace(spark, "quality")
    return _of(work, quality.drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), work=work))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts; null and empty texts are equal."""
    work = Workspace(spark, "exact")
    return _of(work, exact_dedup.drop_exact_copies(docs, work=work))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more. SimHash finds them first, an exact join the pairs that it misses."""
    work = Workspace(spark, "near")
    return _of(work, simhash.drop_near_copies(docs, work=work))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has; n_chars follows the text."""
    work = Workspace(spark, "substring")
    return _of(work, chunk_dedup.drop_repeated_passages(docs, work=work).withColumn("n_chars", F.length("text").cast("long")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences; a null or empty text is its end id alone."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]

#: Models and tokenizers have no SQL form; the tests hold each stage of run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's result written as Parquet and read again.

    Defined results: null texts and empty ones have quality weight 0, are equal to each other (one stays), share no passage and pack as an end
    id; a null id is kept as null; extra columns of documents are carried to the last stage, whatever their names; an empty table gives
    an empty result. Each stage keeps its files in a workspace of its own, so several runs, and stages called by hand, may be in progress at once.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = Workspace(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        result = stage(spark, docs, sf_dir)
        kept = work.save(result, name)
        result._workspace.close()
        work.drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
