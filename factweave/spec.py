"""The specification (S26-S28): datasets, schemas, fields and what is known of them, indexed on the driver."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from factweave.sources.registers import read_many

TABLES = ["dataset", "schema", "field", "datatype", "typology", "pipeline", "dataset-schema", "dataset-field", "schema-field", "issue-type", "provision-rule", "licence"]
#: Prefixes that stand for several datasets (fixed values).
PACKAGE_PREFIXES = {"plan": ["local-plan", "supplementary-plan", "minerals-plan", "waste-plan"]}
#: Collections of the open digital planning programme (fixed values).
ODP_COLLECTIONS = ["article-4-direction", "article-4-direction-area", "conservation-area", "conservation-area-document", "listed-building-outline", "tree-preservation-order", "tree-preservation-zone", "tree"]


class Specification:
    def __init__(self, tables: dict[str, list[dict[str, str]]]):
        self.tables = tables
        self.fields = {r["field"]: r for r in tables.get("field", [])}
        self.datasets = {r["dataset"]: r for r in tables.get("dataset", [])}
        self.schema_fields: dict[str, list[str]] = {}
        for r in tables.get("schema-field", []):
            self.schema_fields.setdefault(r["schema"], []).append(r["field"])
        for r in tables.get("dataset-field", []):
            self.schema_fields.setdefault(r["dataset"], [])
            if r["field"] not in self.schema_fields[r["dataset"]]:
                self.schema_fields[r["dataset"]].append(r["field"])

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> "Specification":
        """All tables of a folder; each is small by nature and collected once."""
        return cls({n: [r.asDict() for r in df.collect()] for n, df in read_many(spark, folder, TABLES).items()})

    def datatypes(self) -> dict[str, str]:
        return {f: r.get("datatype") or "string" for f, r in self.fields.items()}

    def current_fields(self, schema: str | None = None, today: str | None = None) -> list[str]:
        """Fields of a schema (all without one) that have not ended; ``entity`` is always one."""
        today = today or dt.date.today().isoformat()
        names = self.schema_fields.get(schema, []) if schema else list(self.fields)
        live = [f for f in names if not (self.fields.get(f, {}).get("end-date") or "9999") <= today]
        return live if "entity" in live else [*live, "entity"]

    def intermediate_fields(self, schema: str, migrations: dict[str, str]) -> list[str]:
        """Fields before migration: old names instead of those they will get."""
        out = [f for f in self.current_fields(schema) if f not in migrations]
        return list(dict.fromkeys([*out, *migrations.values()]))

    def typology(self, field: str) -> str:
        """The typology of a field, or of the field it descends from."""
        seen: set[str] = set()
        while field and field not in seen:
            seen.add(field)
            row = self.fields.get(field, {})
            if row.get("typology"):
                return row["typology"]
            field = row.get("parent-field", "")
        return ""

    def typologies(self) -> dict[str, str]:
        return {f: self.typology(f) for f in self.fields}

    def prefix(self, dataset: str) -> str:
        return self.datasets.get(dataset, {}).get("prefix") or dataset

    def prefixes(self) -> dict[str, str]:
        return {f: self.prefix(f) for f in self.fields}

    def entity_range(self, dataset: str) -> tuple[int, int] | None:
        row = self.datasets.get(dataset, {})
        low, high = row.get("entity-minimum"), row.get("entity-maximum")
        return (int(low), int(high)) if low and high else None

    def category_fields(self, dataset: str) -> list[str]:
        return [f for f in self.current_fields(dataset) if self.typology(f) == "category"]

    def cardinality_many(self) -> list[str]:
        return [f for f, r in self.fields.items() if r.get("cardinality") == "n"]


def valid_categories(tables: dict[str, DataFrame], fields: dict[str, str], replacements: dict[str, str] | None = None) -> dict[str, list[str]]:
    """The references of each category field's dataset; a field that replaces another shares its values. The tables are code lists."""
    out = {f: sorted(r[0] for r in tables[d].select("reference").distinct().collect()) for f, d in fields.items() if d in tables}
    return out | {new: out[old] for new, old in (replacements or {}).items() if old in out}
