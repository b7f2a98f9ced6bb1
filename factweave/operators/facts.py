"""Facts (R25-R30, W01, A14, O12, K12, J11, J12): long rows of (entity, field, value) with where each came from."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factweave.functions.arrow import arrow_udf
from factweave.functions import geo, text
from factweave.operators.rows import META, add_issues, issue, q

#: Typologies whose fields refer to other entities (fixed values).
REFERENCE_TYPOLOGIES = ("category", "document", "geography", "organisation", "policy", "legal-instrument")

FACT = ("end_date", "entity", "fact", "field", "entry_date", "priority", "reference_entity", "start_date", "value")
FACT_RESOURCE = ("end_date", "fact", "entry_date", "entry_number", "priority", "resource", "start_date")


def pivot_to_facts(row: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """One row for each field that an entry has; ``entity`` and the entry date go along."""
    fields = sorted(f for f in (fields or row.columns) if f not in META and f != "entity")
    held = [c for c in row.columns if c in META]
    date = q("entry-date").alias("entry_date") if "entry-date" in row.columns else F.lit("").alias("entry_date")
    # Spark's unpivot is an Expand, after which generated code for shared expressions does not compile; explode has no such limit.
    cells = F.array(*(F.struct(F.lit(f).alias("field"), q(f).cast("string").alias("value")) for f in fields))
    long = row.select(*held, q("entity").cast("string").alias("entity"), date, F.explode(cells).alias("_cell"))
    return long.select(*held, "entity", "entry_date", "_cell.field", "_cell.value").where("value is not null")


def fact_hash(entity: Column, field: Column, value: Column) -> Column:
    """sha256 of ``entity:field:value``; null where there is no entity."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (entity, field, value)]
    return F.when(parts[0] != "", F.sha2(F.concat_ws(":", *parts), 256))


def with_hash(facts: DataFrame) -> DataFrame:
    return facts.withColumn("fact", fact_hash(q("entity"), q("field"), q("value")))


def combine(facts: DataFrame, separators: dict[str, str]) -> DataFrame:
    """Values of the named fields, distinct and sorted, joined for each entity; every fact gets the joined value.

    The sets are aggregated first and joined back, so a hot entity is reduced before the shuffle. Geometries are united.
    """
    named = facts.where(F.col("field").isin(list(separators)))
    sets = named.where("value <> ''").groupBy("entity", "field").agg(F.array_sort(F.collect_set("value")).alias("_values"))
    joined = F.lit("")
    for field, separator in separators.items():
        value = _union("_values") if field == "geometry" else F.array_join("_values", separator)
        joined = F.when(F.col("field") == field, value).otherwise(joined)
    sets = sets.select(F.col("entity").alias("_entity"), F.col("field").alias("_field"), joined.alias("_joined"))
    same = F.col("entity").eqNullSafe(F.col("_entity")) & (F.col("field") == F.col("_field"))
    done = facts.join(sets, same, "left")
    hit = F.col("field").isin(list(separators))
    done = add_issues(done, F.when(hit, issue(F.col("field"), "combined-value", F.col("entity"))))
    return done.withColumn("value", F.when(hit, F.coalesce("_joined", F.lit(""))).otherwise(F.col("value"))).drop("_entity", "_field", "_joined")


def _union(values: str) -> Column:
    @arrow_udf("string")
    def run(sets: pd.Series) -> pd.Series:
        return sets.map(lambda v: geo.combined(list(v)), na_action="ignore")

    return run(F.col(values))


def reference_parts(facts: DataFrame, typology: dict[str, str], prefixes: dict[str, str]) -> DataFrame:
    """Prefix and reference of facts whose field refers to an entity: the row's prefix, the CURIE's, or the field's."""
    fields = [f for f, t in typology.items() if t in REFERENCE_TYPOLOGIES]
    parts = text.curie_parts("value")
    refers = F.col("field").isin(fields) & (F.coalesce(F.col("value"), F.lit("")) != "")
    prefix = F.coalesce(F.nullif(parts["prefix"], F.lit("")), text.mapped({f: prefixes.get(f, f) for f in fields}, "field"))
    return facts.withColumns({"prefix": F.when(refers, prefix), "reference": F.when(refers, parts["reference"])})


def prune(facts: DataFrame) -> DataFrame:
    """Facts that have a value; an end date may be blank."""
    return facts.where("value <> '' or field = 'end-date'")


def _order(number: str, as_text: bool) -> Column:
    return F.col(number).cast("string") if as_text else F.col(number)


def latest_facts(facts: DataFrame, as_text: bool = False) -> DataFrame:
    """One row a fact: of the lowest priority, then the latest entry.

    ``as_text`` compares priorities and entry numbers as text, as files with string columns have them.
    """
    window = Window.partitionBy("fact").orderBy(_order("priority", as_text).asc_nulls_last(), F.col("entry_date").desc_nulls_last(), _order("entry_number", as_text).desc_nulls_last())
    return facts.withColumn("_n", F.row_number().over(window)).where("_n = 1").select(*FACT)


def fact_resources(facts: DataFrame) -> DataFrame:
    """Where each fact was found, every time."""
    return facts.select(*FACT_RESOURCE)


def last_values(facts: DataFrame) -> DataFrame:
    """Per entity and field the value of highest priority, entry date and resource start, one pass with partial aggregation."""
    rank = F.struct("priority", "entry_date", "start_date", "value")
    return facts.groupBy("entity", "field").agg(F.max_by("value", rank).alias("value"))


def with_latest_start(facts: DataFrame, resources: DataFrame) -> DataFrame:
    """Facts with the latest start date among their resources."""
    starts = resources.groupBy("fact").agg(F.max("start_date").alias("resource_start_date"))
    return facts.join(starts, "fact", "left")


def counts_by_resource(entities: DataFrame, facts: DataFrame, resources: DataFrame) -> DataFrame:
    """How many entities each resource supports."""
    pairs = facts.select("fact", "entity").join(entities.select("entity"), "entity").join(resources.select("fact", "resource"), "fact")
    return pairs.groupBy("resource").agg(F.countDistinct("entity").alias("entity_count"))


def upsert_newest(held: DataFrame, new: DataFrame, keys: list[str], date: str = "entry_date") -> DataFrame:
    """The newer row of each key; on a tie the row that is held stays. One aggregation over both, no join."""
    columns = held.columns
    both = held.withColumn("_held", F.lit(1)).unionByName(new.select(*columns).withColumn("_held", F.lit(0)))
    rest = [c for c in columns if c not in keys]
    best = F.max_by(F.struct(*(q(c) for c in rest)), F.struct(F.coalesce(q(date).cast("string"), F.lit("")), F.col("_held")))
    return both.groupBy(*(q(k) for k in keys)).agg(best.alias("_best")).select(*(q(k) if k in keys else F.col("_best").getField(k).alias(k) for k in columns))
