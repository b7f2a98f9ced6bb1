"""Rule tables of a pipeline (C16): loaded on the driver, resolved for one resource by precedence.

Rules of other datasets are left out; ``pipeline`` is an older name of ``dataset``. Every
call resolves from the loaded rows, so nothing leaks from one resource to the next.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from factweave.functions.text import field_name
from factweave.sources.registers import read_many

TABLES = ["column", "filter", "skip", "patch", "default", "default-value", "combine", "concat", "transform", "lookup", "lookup-rule", "old-entity", "entity-organisation", "expect"]


@dataclass
class Rules:
    """The rules for one resource."""

    columns: dict[str, str] = field(default_factory=dict)
    filters: dict[str, str] = field(default_factory=dict)
    early_filters: dict[str, str] = field(default_factory=dict)
    skips: list[str] = field(default_factory=list)
    patches: dict[str, dict[str, str]] = field(default_factory=dict)
    default_fields: dict[str, str] = field(default_factory=dict)
    default_values: dict[str, str] = field(default_factory=dict)
    combines: dict[str, str] = field(default_factory=dict)
    concats: dict[str, dict] = field(default_factory=dict)
    migrations: dict[str, str] = field(default_factory=dict)
    lookup_rules: list[dict] = field(default_factory=list)


class RuleTables:
    def __init__(self, tables: dict[str, list[dict[str, str]]], dataset: str):
        self.dataset = dataset
        self.tables = {n: [r for r in rows if self._mine(r)] for n, rows in tables.items()}

    @classmethod
    def load(cls, spark: SparkSession, folder: str, dataset: str) -> "RuleTables":
        """All tables but ``lookup`` and ``old-entity``, which stay DataFrames."""
        names = [n for n in TABLES if n not in ("lookup", "old-entity")]
        return cls({n: [r.asDict() for r in df.collect()] for n, df in read_many(spark, folder, names).items()}, dataset)

    def _mine(self, row: dict[str, str]) -> bool:
        owner = row.get("dataset") or row.get("pipeline") or ""
        return owner in ("", self.dataset)

    def _rows(self, table: str, resource: str = "", endpoints=(), general: bool = True):
        """General rows, those of the endpoints and those of the resource."""
        groups: dict[str, list[dict]] = {"general": [], "endpoint": [], "resource": []}
        for row in self.tables.get(table, []):
            r, e = row.get("resource") or "", row.get("endpoint") or ""
            if r:
                if r == resource:
                    groups["resource"].append(row)
            elif e:
                if e in endpoints:
                    groups["endpoint"].append(row)
            elif general:
                groups["general"].append(row)
        return groups

    @staticmethod
    def _dict(rows, key, value) -> dict[str, str]:
        return {r.get(key) or "": r.get(value) or "" for r in rows}

    def resolve(self, resource: str = "", endpoints: tuple[str, ...] = ()) -> Rules:
        out = Rules()
        get = lambda t: self._rows(t, resource, endpoints)

        f = get("filter")
        as_filter = lambda k: self._dict(f[k], "field", "pattern")
        out.early_filters = as_filter("general") | as_filter("resource")
        out.filters = as_filter("general") | as_filter("endpoint") | as_filter("resource")

        c = get("column")
        named = lambda k: {field_name(r.get("column") or r.get("pattern") or ""): r.get("field") or r.get("value") or "" for r in c[k]}
        own = named("resource")
        own |= {k: v for k, v in named("endpoint").items() if k not in own}
        taken = set(own.values())
        out.columns = own | {k: v for k, v in named("general").items() if k not in own and (v not in taken or v == "IGNORE")}

        s = get("skip")
        out.skips = [r["pattern"] for k in ("general", "endpoint", "resource") for r in s[k] if r.get("pattern")]

        p = get("patch")
        by_field: dict[str, dict[str, dict[str, str]]] = {}
        for k in ("general", "endpoint", "resource"):
            for r in p[k]:
                by_field.setdefault(k, {}).setdefault(r.get("field") or "", {})[r["pattern"]] = r.get("value") or ""
        nearer = by_field.get("endpoint", {}) | by_field.get("resource", {})
        general = by_field.get("general", {})
        out.patches = {n: {**general.get(n, {}), **nearer.get(n, {})} for n in {*nearer, *general}}

        d = get("default")
        as_default = lambda k: self._dict(d[k], "field", "default-field")
        out.default_fields = as_default("general") | as_default("resource") | as_default("endpoint")
        v = get("default-value")
        as_value = lambda k: self._dict(v[k], "field", "value")
        out.default_values = as_value("general") | as_value("endpoint") | as_value("resource")

        m = get("combine")
        as_combine = lambda k: self._dict(m[k], "field", "separator")
        out.combines = as_combine("general") | as_combine("endpoint")

        n = get("concat")
        for k in ("general", "resource", "endpoint"):
            for r in n[k]:
                out.concats[r["field"]] = {"fields": [x for x in (r.get("fields") or "").split(";") if x], "separator": r.get("separator") or "", "prepend": r.get("prepend") or "", "append": r.get("append") or ""}

        out.migrations = {r["replacement-field"]: r["field"] for r in self.tables.get("transform", []) if r.get("replacement-field")}
        rules = get("lookup-rule")
        for k in ("general", "resource"):
            for r in rules[k]:
                out.lookup_rules.append({**r, "offset": int(r.get("offset") or 0), "entity-minimum": int(r["entity-minimum"]), "entity-maximum": int(r["entity-maximum"])})
        return out
