"""The corpus pipeline: stages that each read what the stage before wrote.

Every stage works on all rows it is given and all but the last return the columns of ``documents``: documents scored toxic go, of equal texts the
first stays, of each group of near copies the document with the least doc_id stays, documents are repeated or left out as the mix takes
them (one row for each time a document is begun), and what is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadloom.llm import best_fit, exact_dedup, ngram_jaccard, source_mix, toxicity_crf
from roadloom.llm.tables import materialize, read, small_batches


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return toxicity_crf.keep_clean(docs, read(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_jaccard.keep_one(docs, scanned=True)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.take(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit.best_fit(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("ngram_jaccard", near), ("mixing", mixing), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
