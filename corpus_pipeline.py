"""The training-corpus pipeline: each stage takes all documents that its predecessor kept.

Cases: documents with null or blank text have no words and go in the first stage;
documents without id, repeated ids and repeated rows pass as rows of their own, of
which the second stage keeps one for each group of near-duplicates; very long texts
are read whole; an empty table, at any stage, gives an empty result; further columns,
also with names that differ from those of ``documents`` in case only, are carried
along by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factweave.llm import mixing, packing, pii, quality, simhash
from factweave.llm.common import ship_code, stash, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship_code(spark)
    return quality.kept_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles of similarity 0.8 or more."""
    ship_code(spark)
    return simhash.one_of_each(docs, shingle_words=5, similarity=0.8)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    ship_code(spark)
    return pii.masked_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: one row for each copy that it takes of a document."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    ship_code(spark)
    return packing.pack(docs)


STAGES = [("quality", quality_rules), ("simhash", near_duplicates), ("personal data", personal_data), ("mixing", mix_sources), ("packing", pack)]

#: The stages hold trained models and hash draws, which SQL cannot express; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written as Parquet and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stash(docs, f"pipeline-{number}")
    return docs
