"""Entity assembly (W02, W03, A09-A16, J09, J10, F10-F12, F23, C15 helper, O07): facts to one row per entity."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factweave.functions.arrow import arrow_udf
from factweave.functions import geo, jsons
from factweave.operators.rows import q

#: Columns of the entity table (fixed values).
ENTITY_FIELDS = ("dataset", "end_date", "entity", "entry_date", "geojson", "geometry", "json", "name", "organisation_entity", "point", "prefix", "reference", "start_date", "typology", "quality")
#: End date of a resource without one (fixed value); compared as text.
OPEN_END = "2999-12-31"


def winners(facts: DataFrame, resources: DataFrame | None = None) -> DataFrame:
    """Per entity and field the fact of highest priority, then the latest; ``top_priority`` is the entity's highest.

    Facts are ranked within (entity, field); only the best of each partition is shuffled (a window's group limit). The
    entity's priority is then taken over the winners, each of which carries the highest of its field.
    """
    if resources is not None:
        ends = resources.select("resource", F.nullif(q("end-date").cast("string"), F.lit("")).alias("_end"))
        facts = facts.join(ends.groupBy("resource").agg(F.max("_end").alias("_end")), "resource", "left")
    else:
        facts = facts.withColumn("_end", F.lit(None).cast("string"))
    window = Window.partitionBy("entity", "field").orderBy(
        F.col("priority").desc_nulls_last(), F.col("entry_date").desc_nulls_last(), F.col("entry_number").desc_nulls_last(), F.coalesce("_end", F.lit(OPEN_END)).desc(), F.col("resource").asc_nulls_last(), F.col("fact").asc_nulls_last()
    )
    best = facts.withColumn("_n", F.row_number().over(window)).where("_n = 1")
    return best.select("entity", "field", "value", F.max("priority").over(Window.partitionBy("entity")).alias("top_priority"))


def quality(priority: Column) -> Column:
    """A16."""
    return F.when(priority == 1, "some").when(priority == 2, "authoritative").otherwise("else")


def fields_present(facts: DataFrame) -> list[str]:
    """The fields of some facts, in order; a specification's list saves this action."""
    return sorted(r[0] for r in facts.select(F.translate("field", "-", "_").alias("f")).distinct().collect())


def pivoted(best: DataFrame, fields: list[str]) -> DataFrame:
    """One row per entity with a column for each field."""
    values = [F.max(F.when(F.translate("field", "-", "_") == f, F.col("value"))).alias(f) for f in fields]
    return best.groupBy("entity", "top_priority").agg(*values)


def assemble(facts: DataFrame, dataset: str, typology: str, fields: list[str] | None = None, organisations: DataFrame | None = None, resources: DataFrame | None = None, centroids: bool = True) -> DataFrame:
    """The entity table: known columns, all other fields in ``json`` (null if there are none), and what is derived."""
    fields = fields or fields_present(facts)
    table = pivoted(winners(facts, resources), fields)
    others = {f.replace("_", "-"): q(f) for f in fields if f not in ENTITY_FIELDS and f != "organisation"}
    table = table.withColumn("json", jsons.overflow(others))
    if organisations is not None and "organisation" in fields:
        codes = organisations.groupBy("organisation").agg(F.min(q("entity").cast("bigint")).alias("organisation_entity"))
        table = table.join(codes, "organisation", "left")
    else:
        table = table.withColumn("organisation_entity", F.lit(None).cast("bigint"))
    given = {f: q(f) if f in fields else F.lit("") for f in ENTITY_FIELDS if f not in ("entity", "json", "organisation_entity")}
    given |= {"dataset": F.lit(dataset), "typology": F.lit(typology), "quality": quality(F.col("top_priority")), "entity": F.col("entity"), "json": F.col("json"), "organisation_entity": F.col("organisation_entity")}
    if centroids and "geometry" in fields:
        need = (F.coalesce(given["geometry"], F.lit("")) != "") & (F.coalesce(given["point"], F.lit("")) == "")
        given["point"] = F.when(need, geo.centroid_point(F.when(need, given["geometry"]))).otherwise(given["point"])
    return table.select(*(given[f].alias(f) for f in ENTITY_FIELDS))


def entity_bounds(facts: DataFrame) -> DataFrame:
    """A09."""
    return facts.agg(F.min("entity").alias("min_entity"), F.max("entity").alias("max_entity"))


def flatten(entities: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of ``json`` as columns, all in kebab-case, without GeoJSON."""
    base = [q(c).alias(c.replace("_", "-")) for c in entities.columns if c not in ("json", "geojson")]
    known = {c.replace("_", "-") for c in entities.columns}
    return entities.select(*base, *jsons.flattened("json", [k for k in keys if k.replace("_", "-") not in known]))


def json_keys(entities: DataFrame) -> list[str]:
    """The keys of all ``json`` objects (one small distinct)."""
    return sorted(r[0] for r in entities.select(F.explode(F.map_keys(jsons.as_map("json"))).alias("k")).distinct().collect())


def geojson_features(entities: DataFrame) -> DataFrame:
    """A GeoJSON feature text per entity; points and multipolygons from WKT."""
    @arrow_udf("string")
    def shape(values: pd.Series) -> pd.Series:
        return values.map(lambda v: json.dumps({"type": g[0], "coordinates": g[1]}) if v and (g := geo.parse_wkt(v)) else None, na_action="ignore")

    where = F.coalesce(F.nullif(q("geometry"), F.lit("")), F.nullif(q("point"), F.lit("")))
    properties = F.to_json(F.struct(*(q(c) for c in entities.columns if c not in ("geometry", "point"))))
    text = F.concat(F.lit('{"type":"Feature","geometry":'), F.coalesce(shape(where), F.lit("null")), F.lit(',"properties":'), properties, F.lit("}"))
    return entities.select("entity", text.alias("feature"))


def diff(old: DataFrame, new: DataFrame, key: str = "entity", as_json: tuple[str, ...] = ()) -> DataFrame:
    """Fields whose value differs, per entity: ``entity, field, old_value, new_value, new_entity``; JSON is compared with sorted keys."""

    def long(df: DataFrame) -> DataFrame:
        fields = sorted(c for c in df.columns if c != key)
        cell = {c: jsons.canonical(q(c)) if c in as_json else F.coalesce(q(c).cast("string"), F.lit("")) for c in fields}
        wide = df.select(q(key).alias(key), *(v.alias(c) for c, v in cell.items()))
        return wide.unpivot(key, fields, "field", "value")

    a, b = long(old).withColumnRenamed("value", "old_value"), long(new).withColumnRenamed("value", "new_value")
    both = a.join(b, [key, "field"], "full")
    seen = old.select(q(key).alias(key)).distinct().withColumn("_seen", F.lit(True))
    both = both.join(seen, key, "left").withColumn("new_entity", F.col("_seen").isNull()).drop("_seen")
    return both.where(~F.coalesce("old_value", F.lit("")).eqNullSafe(F.coalesce("new_value", F.lit(""))))


def changed_fields(differences: DataFrame, key: str = "entity") -> DataFrame:
    """The names of changed fields per entity, in order."""
    return differences.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("field")), ";").alias("fields"))
