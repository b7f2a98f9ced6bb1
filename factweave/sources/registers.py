"""Scans of registers, logs, specification and configuration."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.operators.rows import q

CSV = {"header": "true", "inferSchema": "false", "quote": '"', "escape": '"', "multiLine": "true"}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV as text columns; blank cells are ''."""
    df = spark.read.options(**CSV).csv(path)
    return df.na.fill("")


def read_register(spark: SparkSession, path: str, drop_day: str | None = None) -> DataFrame:
    """A register, without the entries of one day where asked."""
    df = read_csv(spark, path)
    return df.where(~F.coalesce(q("entry-date"), F.lit("")).startswith(drop_day)) if drop_day else df


def read_log_items(spark: SparkSession, path: str, after: str | None = None) -> DataFrame:
    """JSON log items in ``date/endpoint.json``; older field names are read too, and items up to ``after`` left out.

    The date of an item is its folder's, so that older folders are pruned without opening their files.
    """
    files = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(path).select("value", F.col("_metadata.file_path").alias("path"))
    files = files.withColumn("day", F.regexp_extract("path", r"/([0-9]{4}-[0-9]{2}-[0-9]{2})/[^/]+$", 1))
    if after:
        files = files.where((F.col("day") == "") | (F.col("day") >= after[:10]))
    get = lambda *names: F.coalesce(*(F.get_json_object("value", f"$['{n}']") for n in names), F.lit(""))
    url = get("endpoint-url", "url")
    items = files.select(
        F.coalesce(F.nullif(get("endpoint"), F.lit("")), F.when(url != "", F.sha2(url, 256)), F.regexp_extract("path", r"([^/]+)\.json$", 1)).alias("endpoint"),
        url.alias("endpoint-url"), get("resource").alias("resource"), get("status").alias("status"), get("elapsed").alias("elapsed"), get("exception").alias("exception"),
        F.coalesce(F.get_json_object("value", "$['response-headers']['Content-Type']"), F.lit("")).alias("content-type"),
        F.coalesce(F.get_json_object("value", "$['response-headers']['Content-Length']"), F.lit("")).alias("bytes"),
        F.coalesce(F.nullif(get("entry-date", "datetime"), F.lit("")), F.col("day")).alias("entry-date"),
    )
    return items.where(q("entry-date") > after) if after else items


def read_operational_issues(spark: SparkSession, path: str) -> DataFrame:
    """Issues in ``date/dataset/resource.csv``; the entry date comes from the folder."""
    df = spark.read.options(**CSV).csv(f"{path}/*/*/*.csv").na.fill("")
    day = F.regexp_extract(F.col("_metadata.file_path"), r"/([0-9]{4}-[0-9]{2}-[0-9]{2})/[^/]+/[^/]+$", 1)
    own = F.nullif(q("entry-date"), F.lit("")) if "entry-date" in df.columns else F.lit(None).cast("string")
    return df.withColumn("entry-date", F.coalesce(own, day))


def transformed_schema(as_text: bool = False) -> str:
    """The columns of transformed facts; files of production have priority and numbers as text."""
    number = "string" if as_text else "bigint"
    return f"end_date string, entity bigint, entry_date string, entry_number {number}, fact string, field string, priority {number}, reference_entity {number}, resource string, start_date string, value string"


def read_transformed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Transformed facts from CSV, in snake case, with the entity as a number; the resource is the file's name where no column has it."""
    df = read_csv(spark, path)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.csv)?$", 1)
    df = df if "resource" in df.columns else df.withColumn("resource", name)
    df = df.toDF(*(c.replace("-", "_") for c in df.columns))
    return df.withColumn("entity", F.col("entity").try_cast("bigint")) if "entity" in df.columns else df


def typed_by(df: DataFrame, datatypes: dict[str, str]) -> DataFrame:
    """Columns cast by their datatype; a blank is null."""
    kinds = {"integer": "bigint", "decimal": "double", "latitude": "double", "longitude": "double", "date": "date"}
    blank = lambda c: F.nullif(q(c), F.lit(""))
    return df.select(*((blank(c).try_cast(kinds[datatypes[c]]) if datatypes.get(c) in kinds else q(c)).alias(c) for c in df.columns))


def read_many(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """The tables ``name.csv`` of a folder that are there; each also becomes a view."""
    out = {}
    for name in names:
        path = f"{folder}/{name}.csv"
        if "://" not in folder and not os.path.exists(path):
            continue
        out[name] = read_csv(spark, path)
        out[name].createOrReplaceTempView(name.replace("-", "_"))
    return out
