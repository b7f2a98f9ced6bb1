"""From transformed facts to a dataset's package: facts, where they were found, and entities."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from factweave.operators import entities as en
from factweave.operators import facts as ft
from factweave.sources.sinks import save_package


@dataclass
class Package:
    facts: DataFrame
    fact_resources: DataFrame
    entities: DataFrame


def build(transformed: DataFrame, dataset: str, typology: str, organisations: DataFrame | None = None, resources: DataFrame | None = None, fields: list[str] | None = None) -> Package:
    """Three tables of one scan of ``transformed``; pass ``fields`` (of the specification) to save the only action."""
    return Package(ft.latest_facts(transformed), ft.fact_resources(transformed), en.assemble(transformed, dataset, typology, fields, organisations, resources))


def update(path: str, dataset: str, typology: str, held: Package, new: DataFrame, **tables) -> Package:
    """A package with newer facts merged in, written as a new snapshot under ``path``."""
    fresh = build(new, dataset, typology, **tables)
    merged = Package(
        ft.upsert_newest(held.facts, fresh.facts, ["fact"]),
        held.fact_resources.unionByName(fresh.fact_resources).distinct(),
        ft.upsert_newest(held.entities, fresh.entities, ["entity"]),
    )
    save_package(dataset, path, merged.facts, merged.fact_resources, merged.entities)
    return merged
