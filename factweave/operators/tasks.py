"""Issues and tasks (L01-L07, A05, A06, J22, J23, Q36 helpers): what to do about failed fetches, missing fields and issues.

Task details are JSON texts with a space after each colon and comma, because their hash is part of a task's reference.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.functions.text import mapped
from factweave.operators.rows import q

COLUMNS = ("dataset", "organisation", "endpoint", "resource", "details", "severity", "responsibility", "task-source", "entry-date", "reference")


def quoted(c: Column) -> Column:
    """A JSON string with every character beyond ASCII escaped."""
    text = F.substring(F.to_json(F.array(F.coalesce(c, F.lit("")))), 2, 1 << 30)
    text = F.substring(text, F.lit(1), F.length(text) - 1)
    chars = F.split(text, "")
    plain = F.concat_ws("", F.transform(chars, lambda x: F.when(F.length(F.encode(x, "UTF-16BE")) == 2, F.when(x > "~", F.concat(F.lit("\\u"), F.lower(F.hex(F.encode(x, "UTF-16BE"))))).otherwise(x)).otherwise(F.concat(F.lit("\\u"), F.lower(F.substring(F.hex(F.encode(x, "UTF-16BE")), 1, 4)), F.lit("\\u"), F.lower(F.substring(F.hex(F.encode(x, "UTF-16BE")), 5, 4))))))
    return F.when(text.rlike("[^\\x00-~]"), plain).otherwise(text)


def with_reference(tasks: DataFrame) -> DataFrame:
    """The first 16 digits of the sha256 of what identifies a task."""
    keys = [F.coalesce(q(c), F.lit("")) for c in ("dataset", "endpoint", "resource", "task-source", "details")]
    return tasks.withColumn("reference", F.substring(F.sha2(F.concat_ws("|", *keys), 256), 1, 16)).select(*(q(c) for c in COLUMNS))


def log_tasks(log: DataFrame, dataset: str, organisation: str, entry_date: str) -> DataFrame:
    """A task for each log entry whose status is there and not 200."""
    failed = log.where("status <> '200'")
    status = F.when(F.col("status").rlike("^[0-9]+$"), F.regexp_replace("status", "^0+(?=[0-9])", "")).otherwise(quoted(F.col("status")))
    details = F.concat(F.lit('{"status": '), status, F.lit(', "exception": '), quoted(F.col("exception")), F.lit("}"))
    return with_reference(failed.select(
        F.lit(dataset).alias("dataset"), F.lit(organisation).alias("organisation"), "endpoint", "resource", details.alias("details"),
        F.lit("error").alias("severity"), F.lit("external").alias("responsibility"), F.lit("log").alias("task-source"), F.lit(entry_date).alias("entry-date"),
    ))


def missing_field_tasks(spark: SparkSession, present: set[str], mandatory: list, dataset: str, organisation: str, resource: str, entry_date: str) -> DataFrame:
    """A task for each mandatory field that no column maps to; of a nested list, any one will do."""
    lost: list[str] = []
    for f in mandatory:
        group = f if isinstance(f, list) else [f]
        if not present & set(group):
            lost += group
    rows = [(dataset, organisation, "", resource, json.dumps({"field": f, "issue_type": "missing-field"}), "error", "external", "column-field", entry_date) for f in lost]
    return with_reference(spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in COLUMNS[:-1])))


def issue_tasks(issues: DataFrame, organisation: str, endpoint: str, severities: list[str], responsibilities: list[str], entry_date: str) -> DataFrame:
    """A task per issue type, resource, field and dataset, with the number of issues."""
    rows = issues.where(q("severity").isin(severities) & q("responsibility").isin(responsibilities))
    groups = rows.groupBy("issue-type", "resource", "field", "dataset").agg(F.count("*").alias("n"), F.min("severity").alias("severity"), F.min("responsibility").alias("responsibility"))
    details = F.concat(F.lit('{"issue_type": '), quoted(q("issue-type")), F.lit(', "count": '), F.col("n").cast("string"), F.lit(', "field": '), quoted(q("field")), F.lit("}"))
    return with_reference(groups.select(
        "dataset", F.lit(organisation).alias("organisation"), F.lit(endpoint).alias("endpoint"), "resource", details.alias("details"),
        "severity", "responsibility", F.lit("issue").alias("task-source"), F.lit(entry_date).alias("entry-date"),
    ))


def with_severity(issues: DataFrame, issue_types: DataFrame) -> DataFrame:
    """Severity and responsibility of each issue type."""
    known = issue_types.select(q("issue-type"), "severity", "responsibility").dropDuplicates(["issue-type"])
    return issues.drop("severity", "responsibility").join(F.broadcast(known) if known.limit(10_001).count() <= 10_000 else known, "issue-type", "left")


def with_descriptions(issues: DataFrame, descriptions: dict[tuple[str, str], str]) -> DataFrame:
    """The description of a field's issue type, where there is one; else the message."""
    known = mapped({f"{f}\n{t}": d for (f, t), d in descriptions.items()}, F.concat_ws("\n", "field", q("issue-type")))
    return issues.withColumn("description", F.coalesce(known, F.col("message")))


def issue_summary(issues: DataFrame) -> DataFrame:
    """A06."""
    return issues.groupBy("issue-type", "field").agg(F.count("*").alias("count"))


def column_field_log(spark: SparkSession, dataset: str, resource: str, bound: dict[str, str]) -> DataFrame:
    """Which field each column of a resource was bound to."""
    return spark.createDataFrame([(dataset, resource, c, f) for c, f in bound.items()], "dataset string, resource string, column string, field string")


def resource_log(rows: DataFrame, lines: DataFrame, mime_types: DataFrame | None = None) -> DataFrame:
    """Lines, entries and entities of each resource."""
    out = lines.groupBy("dataset", "resource").agg(F.count("*").alias("line_count"))
    held = rows.groupBy("resource").agg(F.count("*").alias("entry_count"), F.count_distinct(F.nullif(q("entity"), F.lit(""))).alias("entity_count"))
    out = out.join(held, "resource", "left").na.fill(0, ["entry_count", "entity_count"])
    return out.join(mime_types, "resource", "left") if mime_types is not None else out
