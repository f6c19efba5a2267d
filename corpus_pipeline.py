"""Corpus pipeline over ``documents``: classify quality, drop exact copies, drop near copies, drop benchmark leaks, pack.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written as Parquet
and read again. All stages but the last return the columns of ``documents``."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.llm import decontaminate, exact_dedup, near_dedup, packing, quality
from stratum.llm.common import read, stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier accepts."""
    return quality.keep_good(docs)


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id."""
    return exact_dedup.drop_exact_copies(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity of 0.8 or more."""
    return near_dedup.drop_near_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' token pieces, packed into sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality classifier", keep_quality), ("exact dedup", dedup_exact), ("near dedup", dedup_near),
          ("benchmark decontamination", decontaminated), ("best-fit packing", packed)]

#: Classifier, sketches, retrieval and tokenizer have no SQL form; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
