"""The corpus pipeline: toxicity, language ID, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``.  Every stage works on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import table, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents predicted toxic go.  Learns from the labels of rows not held out."""
    from ledgerline.llm.toxicity import keep_ordinary
    return keep_ordinary(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents without a letter or without a clear language go."""
    from ledgerline.llm.language import keep_identified
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of each group of near-duplicates the document with the smallest id stays."""
    from ledgerline.llm.near_dedup import keep_one
    return keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: bytes of repeated passages go; n_chars follows the text."""
    from ledgerline.llm.suffix_dedup import remove
    return remove(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: all that is left, in windows of 2048 tokens."""
    from ledgerline.llm.packing import pack
    return pack(docs)


STAGES = [("toxicity", toxicity), ("language", language), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("packing", packing)]

#: Tokenisers and fitted models have no SQL form; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
