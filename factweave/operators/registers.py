"""Registers of endpoints, sources, resources and lookups."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factweave.functions.dates import register_date
from factweave.functions.text import is_url
from factweave.operators.lookups import lookup_key, lookup_table
from factweave.operators.numbering import numbered
from factweave.operators.rows import q

#: Columns of the registers (fixed values).
SCHEMAS = {
    "log": ["bytes", "content-type", "elapsed", "endpoint", "resource", "status", "entry-date", "start-date", "end-date", "exception"],
    "endpoint": ["endpoint", "endpoint-url", "parameters", "plugin", "entry-date", "start-date", "end-date"],
    "source": ["source", "attribution", "collection", "documentation-url", "endpoint", "licence", "organisation", "pipelines", "entry-date", "start-date", "end-date"],
    "resource": ["resource", "bytes", "organisations", "datasets", "endpoints", "start-date", "end-date"],
    "old-resource": ["old-resource", "status", "resource"],
    "lookup": ["entity", "prefix", "resource", "entry-number", "organisation", "reference", "start-date", "end-date", "entry-date", "endpoint"],
    "lookup-rule": ["prefix", "dataset", "organisation", "resource", "offset", "entity-minimum", "entity-maximum", "entry-date", "start-date", "end-date"],
    "operational-issue": ["dataset", "resource", "line-number", "entry-number", "field", "issue-type", "value", "message", "entry-date"],
}


def parts(c: str) -> Column:
    """The distinct non-blank items of a ``;`` list."""
    return F.array_distinct(F.filter(F.split(F.coalesce(q(c), F.lit("")), ";"), lambda x: x != ""))


def joined(values: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(values)), ";")


def latest(register: DataFrame, key: str, order: str) -> DataFrame:
    """C17: the last entry of each key."""
    rest = [c for c in register.columns if c != key]
    best = F.max_by(F.struct(*(q(c) for c in rest)), q(order)).alias("_e")
    return register.groupBy(q(key)).agg(best).select(q(key), *(F.col("_e").getField(c).alias(c) for c in rest))


def source_datasets(sources: DataFrame) -> Column:
    """The datasets of a source, by its older name where the newer is blank."""
    have = [F.nullif(q(c), F.lit("")) for c in ("datasets", "pipelines") if c in sources.columns]
    return F.coalesce(*have, F.lit(""))


def endpoint_sources(sources: DataFrame) -> DataFrame:
    """``endpoint, o, d``: the organisations and datasets of each endpoint's sources."""
    told = sources.select("endpoint", q("organisation"), F.explode_outer(F.split(source_datasets(sources), ";")).alias("dataset"))
    return told.groupBy("endpoint").agg(F.collect_set(F.nullif(q("organisation"), F.lit(""))).alias("o"), F.collect_set(F.nullif("dataset", F.lit(""))).alias("d"))


def check_endpoints(seen: DataFrame, sources: DataFrame) -> None:
    """Every endpoint seen must have a source."""
    lost = seen.select("endpoint").distinct().join(sources.select("endpoint"), "endpoint", "left_anti").orderBy("endpoint").limit(10).collect()
    if lost:
        raise ValueError(f"endpoints without a source: {[r[0] for r in lost]}")


def resource_rollup(log: DataFrame, sources: DataFrame, today: str | None = None, strict: bool = False) -> DataFrame:
    """One row per resource: first and last day seen, and the endpoints, organisations and datasets behind it.

    Dates and endpoints are aggregated before the join, so the log is shuffled once and small. A resource seen today is open.
    ``strict`` raises if an endpoint of the log has no source.
    """
    today_date = F.current_date().cast("string") if today is None else F.lit(today)
    seen = log.where("resource <> ''").withColumn("day", register_date("entry-date"))
    if strict:
        check_endpoints(seen, sources)
    by_pair = seen.groupBy("resource", "endpoint").agg(F.min("day").alias("start"), F.max("day").alias("end"), F.max_by("bytes", "day").alias("bytes"))
    both = by_pair.join(endpoint_sources(sources), "endpoint", "left")
    out = both.groupBy("resource").agg(
        F.max_by("bytes", "end").alias("bytes"), joined(F.flatten(F.collect_set("o"))).alias("organisations"), joined(F.flatten(F.collect_set("d"))).alias("datasets"),
        joined(F.collect_set("endpoint")).alias("endpoints"), F.min("start").alias("start-date"), F.max("end").alias("_end"),
    )
    return out.withColumn("end-date", F.when(F.col("_end") >= today_date, "").otherwise(F.col("_end"))).drop("_end")


def merge_rollup(held: DataFrame, new: DataFrame, sources: DataFrame, today: str | None = None) -> DataFrame:
    """A rollup over earlier entries and new ones: endpoints are united and days widened. Entries that the new log tells
    of take its organisations and datasets; all others derive theirs anew from the sources of their endpoints, so that
    changes of the configuration reach them. An endpoint of an earlier entry without a source raises."""
    today_date = F.current_date().cast("string") if today is None else F.lit(today)
    a, b = held.alias("a"), new.alias("b")
    both = a.join(b, F.col("a.resource") == F.col("b.resource"), "full")
    endpoints = joined(F.filter(F.concat(F.split(F.coalesce("a.endpoints", F.lit("")), ";"), F.split(F.coalesce("b.endpoints", F.lit("")), ";")), lambda x: x != ""))
    end = F.greatest(F.coalesce(F.col("b.`end-date`"), F.col("a.`end-date`")), F.coalesce(F.col("a.`end-date`"), F.col("b.`end-date`")))
    open_ = F.coalesce(F.col("b.`end-date`") == "", F.lit(False))
    ended = F.when(F.col("b.resource").isNull(), F.col("a.`end-date`")).when(open_ | (end >= today_date), "").otherwise(end)
    out = both.select(
        F.coalesce("a.resource", "b.resource").alias("resource"), F.coalesce("b.bytes", "a.bytes").alias("bytes"), F.col("b.organisations").alias("organisations"), F.col("b.datasets").alias("datasets"), endpoints.alias("endpoints"),
        F.least(F.coalesce(F.col("a.`start-date`"), F.col("b.`start-date`")), F.coalesce(F.col("b.`start-date`"), F.col("a.`start-date`"))).alias("start-date"), ended.alias("end-date"),
    )
    old = out.where("organisations is null").select("resource", F.explode(F.split("endpoints", ";")).alias("endpoint")).where("endpoint <> ''")
    check_endpoints(old, sources)
    told = old.join(endpoint_sources(sources), "endpoint").groupBy("resource").agg(joined(F.flatten(F.collect_set("o"))).alias("_o"), joined(F.flatten(F.collect_set("d"))).alias("_d"))
    out = out.join(told, "resource", "left").withColumn("organisations", F.coalesce("organisations", "_o", F.lit(""))).withColumn("datasets", F.coalesce("datasets", "_d", F.lit("")))
    return out.drop("_o", "_d")


def dataset_resources(resources: DataFrame, sources: DataFrame, today: str | None = None) -> DataFrame:
    """``dataset, resource`` through the endpoints; entries whose end date lies in the future are left out, as the rule has it."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss") if today is None else F.lit(today)
    open_ = lambda df: df.where(~((F.coalesce(q("end-date"), F.lit("")) != "") & (q("end-date") > now)))
    told = open_(sources).select("endpoint", F.explode(F.filter(F.split(source_datasets(sources), ";"), lambda x: x != "")).alias("dataset")).distinct()
    seen = open_(resources).where("resource <> ''").select("resource", F.explode(parts("endpoints")).alias("endpoint"))
    return seen.join(told, "endpoint").select("dataset", "resource").distinct()


def redirects(mapped: DataFrame, old_resources: DataFrame) -> DataFrame:
    """``dataset, resource, redirect, retired``: a resource replaced by another, or retired (status 410)."""
    old = old_resources.select(q("old-resource").alias("resource"), q("resource").alias("redirect"), (q("status").cast("string") == "410").alias("retired"))
    out = mapped.join(old.dropDuplicates(["resource"]), "resource", "left")
    return out.select("dataset", "resource", F.coalesce(F.nullif("redirect", F.lit("")), "resource").alias("redirect"), F.coalesce("retired", F.lit(False)).alias("retired"))


def transform_counts(mapped: DataFrame, old_resources: DataFrame) -> DataFrame:
    """Per dataset the number and sorted list of resources to transform, retired ones excluded."""
    live = redirects(mapped, old_resources).where("not retired")
    return live.groupBy("dataset").agg(F.count("*").alias("transform_count"), joined(F.collect_set("resource")).alias("resources"))


def needs_processing(mapped: DataFrame, done: DataFrame, code: str, config_hash: str, specification_hash: str) -> DataFrame:
    """Resources never processed, or processed with other code, configuration or specification."""
    marks = done.select("dataset", "resource", F.struct("code_version", "config_hash", "specification_hash").alias("_was"))
    out = mapped.join(marks, ["dataset", "resource"], "left")
    was = F.concat_ws("|", "_was.code_version", "_was.config_hash", "_was.specification_hash")
    return out.where(F.col("_was").isNull() | (was != f"{code}|{config_hash}|{specification_hash}")).drop("_was")


def source_key(collection: Column, organisation: Column, endpoint: Column) -> Column:
    """F16: md5 of the three, joined by pipes."""
    return F.md5(F.concat_ws("|", *(F.coalesce(c, F.lit("")) for c in (collection, organisation, endpoint))))


def endpoint_key(url: Column) -> Column:
    """F16."""
    return F.sha2(url, 256)


def new_endpoints(candidates: DataFrame, held: DataFrame, entry_date: str) -> DataFrame:
    """Endpoints of valid addresses that the register lacks, with their hash."""
    rows = candidates.where(is_url("endpoint-url")).withColumn("endpoint", endpoint_key(q("endpoint-url")))
    rows = rows.join(held.select("endpoint"), "endpoint", "left_anti").dropDuplicates(["endpoint"])
    have = lambda c: q(c) if c in rows.columns else F.lit(entry_date if c == "entry-date" else "")
    return rows.select(*(have(c).alias(c) for c in SCHEMAS["endpoint"]))


def new_sources(candidates: DataFrame, held: DataFrame, entry_date: str) -> DataFrame:
    """Sources that the register lacks, with their key."""
    rows = candidates.withColumn("source", source_key(q("collection"), q("organisation"), q("endpoint")))
    rows = rows.join(held.select("source"), "source", "left_anti").dropDuplicates(["source"])
    have = lambda c: q(c) if c in rows.columns else F.lit(entry_date if c == "entry-date" else "")
    return rows.select(*(have(c).alias(c) for c in SCHEMAS["source"]))


def retire(register: DataFrame, key: str, keys: list[str], end_date: str) -> DataFrame:
    """Set the end date of listed entries; none is changed if one of them is missing."""
    found = {r[0] for r in register.where(q(key).isin(keys)).select(q(key)).distinct().collect()}
    if lost := sorted(set(keys) - found):
        raise ValueError(f"not in the register: {lost}")
    return register.withColumn("end-date", F.when(q(key).isin(keys) & (F.coalesce(q("end-date"), F.lit("")) == ""), end_date).otherwise(q("end-date")))


def max_entity(lookups: DataFrame, prefix: str) -> DataFrame:
    """A10."""
    return lookups.where(q("prefix") == prefix).agg(F.coalesce(F.max(q("entity").try_cast("bigint")), F.lit(0)).alias("max_entity"))


def free_entities(used: DataFrame, low: int, high: int, start: int, wanted: int) -> DataFrame:
    """``position, entity``: the first free numbers from ``start`` on, wrapping around within the range.

    Candidates are the next ``wanted`` + used numbers only, not the whole range.
    """
    taken = used.select(q("entity").try_cast("bigint").alias("entity")).where(F.col("entity").between(low, high)).distinct()
    spark, span = used.sparkSession, high - low + 1
    n = min(span, wanted + taken.count())
    first = start if low <= start <= high else low
    numbers = spark.range(n).select(F.col("id").alias("position"), (F.lit(low) + (F.lit(first - low) + F.col("id")) % span).alias("entity"))
    free = numbers.join(taken, "entity", "left_anti").orderBy("position").limit(wanted)
    return free.select((F.row_number().over(Window.orderBy("position")) - 1).cast("bigint").alias("position"), "entity")


def assign_entities(missing: DataFrame, lookups: DataFrame, low: int, high: int, old_entities: DataFrame | None = None) -> DataFrame:
    """New lookup rows for ``prefix, organisation, reference`` that have none, numbered after the highest in use."""
    key = lookup_key("", q("prefix"), q("reference"), q("organisation"))
    new = missing.withColumn("key", key).dropDuplicates(["key"]).join(lookup_table(lookups).select("key"), "key", "left_anti")
    used = lookups.select(q("entity"))
    if old_entities is not None:
        used = used.unionByName(old_entities.select(q("old-entity").alias("entity")))
    inside = used.select(q("entity").try_cast("bigint").alias("e")).where(F.col("e").between(low, high))
    top = inside.agg(F.max("e")).first()[0]
    placed = numbered(new, ["prefix", "organisation", "reference"], "position")
    return placed.join(free_entities(used, low, high, (top or low - 1) + 1, new.count()), "position").select("prefix", "organisation", "reference", "entity")


def redirections(pairs: DataFrame, held: DataFrame, entry_date: str) -> DataFrame:
    """301 rows for ``old-entity, entity`` pairs, after those held."""
    rows = pairs.select(q("old-entity"), F.lit("301").alias("status"), q("entity"), F.lit(entry_date).alias("entry-date"))
    return held.unionByName(rows.join(held.select("old-entity"), "old-entity", "left_anti"), allowMissingColumns=True)


def merged_by_curie(entries: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key; of each column the last non-blank value."""
    cols = [c for c in entries.columns if c not in (key, order)]
    value = lambda c: F.max_by(q(c), F.when(F.coalesce(q(c), F.lit("")) != "", q(order)))
    return entries.groupBy(q(key)).agg(*(F.coalesce(value(c), F.lit("")).alias(c) for c in cols))


def canonical_item(item: dict) -> str:
    """The text of a register item by which it is hashed."""
    return json.dumps(item, sort_keys=True)
