"""The queries of the training-data operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.llm import bitsliced, chunks, hosts, licences, mixing, packing, pii, quality, simhash, wrappers
from factweave.llm.common import ship_code, table


def op1_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeated_passages(table(spark, sf_dir, "documents"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return bitsliced.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = hosts.judge_urls(pages, hosts.label_outcomes(pages, table(spark, sf_dir, "labels")))
    return judged.withColumn("bad_rate_bound", F.round("bad_rate_bound", 6))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_extract": op1_extract,
    "op2_substrings": op2_substrings,
    "op3_top_k": op3_top_k,
    "op4_licences": op4_licences,
    "op5_simhash": op5_simhash,
    "op6_quality": op6_quality,
    "op7_pack": op7_pack,
    "op8_hosts": op8_hosts,
    "op9_mix_sources": op9_mix_sources,
    "op10_personal_data": op10_personal_data,
}
ORACLE_SQL: dict[str, str] = {"op4_licences": licences.oracle_sql(), "op8_hosts": hosts.oracle_sql()}


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _shipped(query) for name, query in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
