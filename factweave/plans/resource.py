"""From a resource's lines to facts and issues: one lazily built plan, with no action but the read of the header."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.operators import facts as ft
from factweave.operators import lookups as lk
from factweave.operators import rows as rw
from factweave.rules import Rules
from factweave.spec import ODP_COLLECTIONS, PACKAGE_PREFIXES, Specification


@dataclass
class Transformed:
    harmonised: DataFrame
    facts: DataFrame
    issues: DataFrame
    columns: dict[str, str]


def headers_of(lines: DataFrame) -> list[str]:
    """The cells of a resource's first line (one row to the driver). The lines must be of one resource."""
    found = lines.agg(F.min_by("line", "line_number").alias("line"), F.min("resource").alias("one"), F.max("resource").alias("other")).first()
    if found["one"] != found["other"]:
        raise ValueError(f"lines of several resources: {found['one']}, {found['other']}; headers are bound one resource at a time")
    return list(dict.fromkeys(h for h in found["line"] or [] if h is not None))


def transform(
    lines: DataFrame,
    specification: Specification,
    dataset: str,
    rules: Rules,
    lookups: DataFrame,
    old_entities: DataFrame,
    organisations: DataFrame | None = None,
    entity_organisations: DataFrame | None = None,
    providers: tuple[str, ...] = (),
    categories: dict[str, list[str]] | None = None,
    entry_date: str = "",
    callback: Callable[[DataFrame], DataFrame] | None = None,
) -> Transformed:
    """The steps of a resource, in order. ``callback`` may change the rows before they are mapped."""
    schema = dataset
    clean = rw.normalise_lines(lines, rules.skips)
    headers = headers_of(clean)
    row = rw.parse_lines(clean).withColumn("dataset", F.lit(dataset)).withColumn("issues", rw.no_issues())
    row = rw.map_to_columns(row, headers)
    row = callback(row) if callback else row
    row = rw.concat_fields(row, rules.concats)
    row = rw.filter_rows(row, rules.early_filters)
    bound = rw.bind_headers(rw.fields_of(row), specification.intermediate_fields(schema, rules.migrations), rules.columns)
    row = rw.map_fields(row, bound)
    row = rw.filter_rows(row, rules.filters)
    row = rw.patch(row, rules.patches)
    row = rw.harmonise(row, specification.datatypes(), dataset, categories)
    values = dict(rules.default_values)
    if entry_date:
        values.setdefault("entry-date", entry_date)
    if len(providers) == 1:
        values.setdefault("organisation", providers[0])
    row = rw.apply_defaults(row, rules.default_fields, values)
    row = rw.migrate(row, [*specification.current_fields(schema), *(f for f in ("organisation", "prefix", "reference", "entity") if f not in specification.current_fields(schema))], rules.migrations)
    if "organisation" not in row.columns:
        row = row.withColumn("organisation", F.lit(""))
    if organisations is not None:
        row = rw.resolve_organisation(row, rw.organisation_aliases(organisations))
    row = rw.prune_fields(row, specification.current_fields(schema))
    row = rw.entry_reference(row, dataset, specification.prefix(dataset))
    harmonised = lk.resolve_for_providers(row, lookups, list(providers), old_entities, rules.lookup_rules) if len(providers) > 1 else lk.resolve_entities(row, lookups, old_entities, rules.lookup_rules, specification.entity_range(dataset))
    entries = rw.prune_entries(harmonised)
    entries = lk.prioritise(entries, entity_organisations, list(providers)) if entity_organisations is not None else entries.withColumn("priority", F.lit(1))
    facts = ft.pivot_to_facts(entries.withColumn("issues", rw.no_issues()).withColumn("provider", F.col("organisation"))).withColumnRenamed("provider", "organisation")
    if rules.combines:
        facts = ft.combine(facts, rules.combines)
    facts = ft.with_hash(facts)
    facts = ft.reference_parts(facts, specification.typologies(), specification.prefixes())
    facts = lk.resolve_references(facts, lookups, old_entities, rules.lookup_rules, PACKAGE_PREFIXES, ODP_COLLECTIONS)
    facts = ft.prune(facts)
    found = rw.issue_rows(harmonised.drop("priority")).unionByName(rw.issue_rows(facts))
    out = facts.select(F.lit("").alias("end_date"), F.col("entity").try_cast("bigint").alias("entity"), "entry_date", F.col("entry_number").cast("bigint").alias("entry_number"), "fact", "field", F.col("priority").cast("bigint").alias("priority"), F.col("reference_entity").try_cast("bigint").alias("reference_entity"), "resource", F.lit("").alias("start_date"), "value")
    return Transformed(harmonised, out, found, bound)
