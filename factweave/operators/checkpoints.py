"""Checkpoints: rules run over a CSV table or a dataset's package, and their log (Q25, Q26, Q28, Q29, Q34, Q35).

A dataset's rules name operations on its entities, facts and fact resources. What an
operation needs from elsewhere (a boundary, the active resources, a timetable) comes in a
``Context``, so that a run needs no network.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.operators import checks as ck
from factweave.operators import spatial
from factweave.operators.checks import COMPARISONS, DETAILS, Verdict
from factweave.operators.rows import q

#: Columns of an expectation log (fixed values).
LOG = ("dataset", "organisation", "name", "operation", "passed", "parameters", "message", "details", "description", "severity", "responsibility")


@dataclass
class Context:
    """A dataset's tables, and what operations need besides."""

    entities: DataFrame
    facts: DataFrame | None = None
    fact_resources: DataFrame | None = None
    #: The WKT boundary of a planning authority, or None.
    boundary: Callable[[str], str | None] = lambda lpa: None
    #: ``organisation_entity, resource`` of resources in use.
    active: DataFrame | None = None
    #: The entities of the timetable, or None if there is none.
    timetable: DataFrame | None = None
    columns: dict[str, list[str]] = field(default_factory=dict)


def _gathered(entities: DataFrame, limit: int = DETAILS) -> tuple[int, list]:
    """The number of entities, and the first of them in order."""
    rows = [r[0] for r in entities.select("entity").orderBy("entity").limit(limit + 1).collect()]
    return (len(rows), rows) if len(rows) <= limit else (entities.count(), rows[:limit])


def _compared(actual: int, expected: int, rule: str) -> bool:
    if rule not in COMPARISONS:
        raise ValueError(f"Invalid comparison_operator: '{rule}'. Must be one of {list(COMPARISONS)}.")
    return COMPARISONS[rule](actual, expected)


def count_lpa_boundary(c: Context, lpa: str, expected: int, organisation_entity=None, comparison_rule: str = "equals_to", geometric_relation: str = "within") -> Verdict:
    """Q25: the number of entities in some relation to an authority's boundary."""
    if geometric_relation not in spatial.RELATIONS:
        raise ValueError(f"Invalid geometric_relation: '{geometric_relation}'. Must be one of {list(spatial.RELATIONS)}.")
    area = c.boundary(lpa)
    if area is None:
        return Verdict(False, f"An error occurred when retrieving lpa geometry of {lpa}", {})
    rows = c.entities if organisation_entity in (None, "") else c.entities.where(F.col("organisation_entity") == int(organisation_entity))
    actual, entities = _gathered(spatial.related(rows, area, geometric_relation))
    return Verdict(_compared(actual, expected, comparison_rule), f"there were {actual} entities found", {"actual": actual, "expected": expected, "entities": entities})


def count_deleted_entities(c: Context, expected: int, organisation_entity) -> Verdict:
    """Q26: the number of an organisation's entities that no resource in use supports."""
    active = c.active.where(F.col("organisation_entity") == int(organisation_entity)).select("resource")
    gone = ck.deleted_entities(c.entities, c.facts, c.fact_resources, active, int(organisation_entity))
    actual, entities = _gathered(gone)
    return Verdict(actual == expected, f"there were {actual} entities found", {"actual": actual, "expected": expected, "entities": entities})


def duplicate_geometry_check(c: Context, spatial_field: str) -> Verdict:
    """Q28: pairs of entities of the same point, or of geometries that cover one another by more than 95 %, or at all."""
    if spatial_field not in ("geometry", "point"):
        raise ValueError(f"Spatial field for duplicate geometry check must be 'point' or 'geometry', not '{spatial_field}'")
    pairs = spatial.duplicate_geometries(c.entities) if spatial_field == "geometry" else spatial.equal_points(c.entities).withColumn("kind", F.lit("two-way"))
    owners = c.entities.select("entity", "organisation_entity")
    for k in "ab":
        pairs = pairs.join(owners.select(F.col("entity").alias(f"entity_{k}"), F.col("organisation_entity").alias(f"organisation_entity_{k}")), f"entity_{k}", "left")
    names = ["entity_a", "organisation_entity_a", "entity_b", "organisation_entity_b"]
    counts = {r["kind"]: r["n"] for r in pairs.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    found = {k: [] for k in ("two-way", "one-way", "any")}
    for r in pairs.select("kind", *names).orderBy("entity_a", "entity_b").limit(DETAILS).collect():
        found[r["kind"]].append({n: r[n] for n in names})
    n = {k: counts.get(k, 0) for k in found}
    if not counts:
        message = "There are no duplicate geometries/points in the dataset"
    elif spatial_field == "geometry":
        message = f"There are {n['two-way']} complete matches, {n['one-way']} single matches and {n['any']} any matches in the dataset"
    else:
        message = f"There are {n['two-way']} complete matches in the dataset"
    return Verdict(not counts, message, {"actual": sum(n.values()), "expected": 0, "complete_matches": found["two-way"], "single_matches": found["one-way"], "any_matches": found["any"]})


def check_fields_required_after_plan_event(c: Context, fields: list[str], plan_event: str = "proposed-plan-consultation-start", today: str | None = None, **_) -> Verdict:
    """Q29: fields that plans lack although an event of theirs is past. Without a timetable the check is skipped."""
    if not fields:
        raise ValueError("At least one field must be provided to check")
    if c.timetable is None:
        return Verdict(True, "plan-timetable not available, check skipped", {"skipped": True, "failures": []})
    past = ck.past_event(c.entities, c.timetable, plan_event, None if today is None else F.lit(today).cast("date"))
    plans = past.count()
    lost = F.explode(F.array_compact(F.array(*(F.when(ck.jsons.is_blank("json", f), F.lit(f)) for f in fields))))
    rows = past.select(F.coalesce(ck.jsons.value_of("json", "organisations"), F.lit("")).alias("organisation"), "organisation_entity", "reference", lost.alias("field"), F.col("event_date").cast("string").alias("actual-date"))
    first = rows.orderBy("reference", "field").limit(DETAILS + 1).collect()
    n = len(first) if len(first) <= DETAILS else rows.count()
    details = {"failures": [r.asDict() for r in first[:DETAILS]], "fields": fields, "plan_event": plan_event, "plans_past_event": plans}
    return Verdict(n == 0, f"{n} missing values found across {plans} plans which have passed {plan_event}", details)


def check_columns(c: Context, expected: dict[str, list[str]]) -> Verdict:
    """Q27: the columns that tables should have."""
    tables = {"entity": c.entities, "fact": c.facts, "fact_resource": c.fact_resources}
    details = []
    for name, wanted in expected.items():
        actual = tables[name].columns if tables.get(name) is not None else []
        missing = [x for x in wanted if x not in actual]
        details.append({"table": name, "success": not missing, "missing": missing, "actual": actual, "expected": wanted})
    good = sum(d["success"] for d in details)
    return Verdict(good == len(details), f"{good} out of {len(details)} tables had expected columns", {"tables": details})


#: What the rules of a dataset may name.
DATASET_OPERATIONS: dict[str, Callable[..., Verdict]] = {
    "check_fields_required_after_plan_event": check_fields_required_after_plan_event,
    "count_lpa_boundary": count_lpa_boundary,
    "count_deleted_entities": count_deleted_entities,
    "duplicate_geometry_check": duplicate_geometry_check,
    "check_columns": check_columns,
}


def rule_organisations(names: str, organisations: list[dict[str, str]]) -> list[dict[str, str]]:
    """Q34: the organisations that a rule names, each by its identifier, one of its other names, or all of a class (the part before the colon)."""
    out = []
    for name in filter(None, names.split(";")):
        own = [o for o in organisations if name in (o.get("organisation"), o.get("name"), o.get("entity"))]
        own = own[:1] or [o for o in organisations if o.get("dataset") == name or (o.get("organisation") or "").split(":")[0] == name]
        if not own:
            raise ValueError(f"Cannot attribute organisations to the provided value {name}")
        out += own
    return out


def expectations(rules: list[dict], organisations: list[dict[str, str]], weekday: str, operations: dict[str, Callable] | None = None) -> tuple[list[dict], list[str]]:
    """Q34: what a dataset's rules ask for on a weekday, one entry for each organisation that a rule names; and the names of rules left for other days."""
    operations = DATASET_OPERATIONS if operations is None else operations
    out, skipped = [], []
    for rule in rules:
        if rule.get("schedule") and rule["schedule"].lower() != weekday.lower():
            skipped.append(rule["name"])
            continue
        if rule["operation"] not in operations:
            raise ValueError(f"Unknown operation: '{rule['operation']}'. Must be one of {list(operations)}.")
        for o in rule_organisations(rule.get("organisations") or "", organisations) if rule.get("organisations") else [{}]:
            filled = {k: ck.rendered(rule.get(k) or "", o) if o else rule.get(k) or "" for k in ("name", "description")}
            text = rule.get("parameters") or "{}"
            parameters = text if isinstance(text, dict) else json.loads(ck.rendered(text, o) if o else text)
            out.append({"operation": rule["operation"], **filled, "organisation": o.get("organisation") or "", "severity": rule.get("severity") or "", "responsibility": rule.get("responsibility") or "", "parameters": parameters})
    return out, skipped


def run(context: Context, asked: list[dict], dataset: str, operations: dict[str, Callable] | None = None) -> list[dict]:
    """Q35: the log entries of some expectations; the entities are read once."""
    operations = DATASET_OPERATIONS if operations is None else operations
    held = context.entities
    context.entities = held.persist()
    try:
        out = []
        for e in asked:
            result = operations[e["operation"]](context, **e["parameters"])
            out.append({**e, "dataset": dataset, "passed": str(result.passed), "message": result.message, "details": json.dumps(result.details, default=str), "parameters": json.dumps(e["parameters"])})
        return out
    finally:
        context.entities.unpersist()
        context.entities = held


def log_path(output: str, dataset: str) -> str:
    return f"{output}/dataset={dataset}"


def save(spark: SparkSession, entries: list[dict], skipped: list[str], output: str, dataset: str) -> None:
    """The log of a dataset, in its own folder; entries of rules left for other days are carried over from the log before."""
    schema = ", ".join(f"{c} string" for c in LOG)
    rows = [tuple(e.get(c, "") for c in LOG) for e in entries]
    path = log_path(output, dataset)
    if skipped and ("://" in path or os.path.exists(path)):
        before = spark.read.schema(schema).parquet(path).where(q("name").isin(skipped)).collect()  # a log: some rows for each rule
        rows += [tuple(dataset if c == "dataset" else r[c] for c in LOG) for r in before]
    spark.createDataFrame(rows, schema).drop("dataset").coalesce(1).write.mode("overwrite").parquet(path)
