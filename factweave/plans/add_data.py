"""Adding an endpoint's data (C03, C10, C11, C13): checks of the request, register entries, a fetch, a trial transform, and entity numbers.

``validate`` looks at the whole request before anything is written; ``add`` then
collects the endpoint, transforms its resource for each dataset, assigns numbers to
entities that no lookup knows, transforms again, and returns what it would save. Only
``save`` writes registers and lookups, so a caller can ask in between.
"""

from __future__ import annotations

import csv
import datetime as dt
import io
import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.functions.text import is_date, is_url
from factweave.operators import registers as rg
from factweave.operators import tasks as tk
from factweave.operators.rows import q
from factweave.plans import resource as rs
from factweave.rules import RuleTables
from factweave.sources import collect, resources
from factweave.sources.registers import read_csv
from factweave.spec import Specification

#: Columns that a request must have (fixed values).
REQUIRED = ("pipelines", "organisation", "documentation-url", "endpoint-url", "start-date", "licence")
UNKNOWN = ("unknown entity", "unknown entity - missing reference")
#: Fields that a transform fills by itself (fixed values).
GENERATED = ("entity", "organisation", "prefix")


def validate(request: DataFrame, specification: Specification, organisations: DataFrame, collection: str) -> list[str]:
    """What is wrong with a request (a few rows of a form), in the order of its rows; nothing if it may be added."""
    if missing := [c for c in REQUIRED if c not in request.columns]:
        return [f"required column ({c}) not found in csv" for c in missing]
    licences = {r.get("licence") for r in specification.tables.get("licence", [])}
    known = {r[0] for r in organisations.select("organisation").distinct().collect()}
    judged = request.select(*(F.coalesce(q(c), F.lit("")).alias(c) for c in REQUIRED), F.coalesce(is_url("endpoint-url"), F.lit(False)).alias("_endpoint"), F.coalesce(is_url("documentation-url"), F.lit(False)).alias("_documentation"), is_date("start-date").alias("_date"))
    faults = []
    for r in judged.collect():
        if not r["licence"]:
            faults.append("Licence is blank")
        elif r["licence"] not in licences:
            faults.append(f"Licence '{r['licence']}' is not a valid licence according to the specification.")
        for name, good in (("endpoint-url", r["_endpoint"]), ("documentation-url", r["_documentation"])):
            if not good:
                faults.append(f"{name} is not a valid url: '{r[name]}'" if r[name] else f"The {name} must be populated")
        if r["start-date"] and not r["_date"]:
            faults.append(f"start-date '{r['start-date']}' must be in the form YYYY-MM-DD")
        if not r["organisation"]:
            faults.append("The organisation must not be blank")
        elif r["organisation"] not in known:
            faults.append(f"The given organisation '{r['organisation']}' is not in our valid organisations")
        for name in r["pipelines"].split(";"):
            if name not in specification.datasets:
                faults.append(f"'{name}' is not a valid dataset in the specification")
            elif specification.datasets[name].get("collection") not in (collection, None):
                faults.append(f"'{name}' does not belong to provided collection {collection}")
    return faults


def entries(request: DataFrame, collection: str, endpoints: DataFrame, sources: DataFrame, entry_date: str) -> tuple[DataFrame, DataFrame]:
    """The endpoint and source entries that a request adds to the registers."""
    keyed = request.withColumn("endpoint", rg.endpoint_key(q("endpoint-url"))).withColumn("collection", F.lit(collection))
    return rg.new_endpoints(request, endpoints, entry_date), rg.new_sources(keyed, sources, entry_date)


@dataclass
class Trial:
    """What a dataset makes of a resource."""

    dataset: str
    resource: str
    transformed: rs.Transformed
    lookups: DataFrame
    assigned: DataFrame | None = None

    def unknown(self) -> DataFrame:
        return self.transformed.issues.where(F.col("issue_type").isin(*UNKNOWN))


@dataclass
class Addition:
    endpoints: DataFrame
    sources: DataFrame
    trials: list[Trial] = field(default_factory=list)


def _trial(spark: SparkSession, name: str, dataset: str, lines: DataFrame, specification: Specification, folder: str, endpoint: str, organisation: str, lookups: DataFrame, entry_date: str) -> Trial:
    rules = RuleTables.load(spark, folder, dataset).resolve(name, (endpoint,))
    table = lambda n, columns: read_csv(spark, f"{folder}/{n}.csv") if os.path.exists(f"{folder}/{n}.csv") else spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
    out = rs.transform(lines, specification, dataset, rules, lookups, table("old-entity", ["old-entity", "status", "entity"]), providers=(organisation,), entry_date=entry_date)
    return Trial(dataset, name, out, lookups)


def assign(trial: Trial, low: int, high: int) -> DataFrame:
    """Lookup rows for the entries of a trial that have a reference and no entity."""
    rows = trial.transformed.harmonised.where(F.coalesce(q("entity"), F.lit("")) == "")
    rows = rows.where((F.coalesce(q("reference"), F.lit("")) != "") & (F.coalesce(q("prefix"), F.lit("")) != "")).select("prefix", "organisation", "reference").distinct()
    return rg.assign_entities(rows, trial.lookups, low, high)


def add(
    spark: SparkSession, request: DataFrame, collection: str, collection_dir: str, pipeline_dir: str, specification: Specification, organisations: DataFrame, now: dt.datetime,
    confirm: Callable[[str], bool] = lambda question: True, fetch: Callable | None = None,
) -> Addition:
    """Check a request, fetch its endpoints, and try their resources; ``confirm`` is asked before numbers are assigned."""
    if faults := validate(request, specification, organisations, collection):
        raise ValueError("; ".join(faults))
    day = now.strftime("%Y-%m-%d")
    held = {n: read_csv(spark, f"{collection_dir}/{n}.csv") if os.path.exists(f"{collection_dir}/{n}.csv") else spark.createDataFrame([], ", ".join(f"`{c}` string" for c in rg.SCHEMAS[n])) for n in ("endpoint", "source")}
    new_endpoints, new_sources = entries(request, collection, held["endpoint"], held["source"], day)
    fresh = {r["endpoint-url"]: r.asDict() for r in new_endpoints.collect()}  # a request has a few rows
    asked = [r.asDict() for r in request.collect()]
    if lost := [r["endpoint-url"] for r in asked if r["endpoint-url"] not in fresh]:
        raise ValueError(f"Endpoint and source could not be added - is this a duplicate endpoint? {lost}")
    out = Addition(held["endpoint"].unionByName(new_endpoints, allowMissingColumns=True), held["source"].unionByName(new_sources, allowMissingColumns=True))
    collector = collect.Collector(collection_dir, {"": fetch} if fetch else None)
    lookups = read_csv(spark, f"{pipeline_dir}/lookup.csv")
    for r in asked:
        endpoint = fresh[r["endpoint-url"]]
        status = collector.fetch({**endpoint, "plugin": r.get("plugin") or "", "parameters": r.get("parameters") or ""}, now, refill=True)
        item = collector.item(now, endpoint["endpoint"])
        if status not in (collect.OK, collect.ALREADY_FETCHED) or item.get("status") != "200" or not item.get("resource"):
            raise OSError(f"Failed to collect from URL. fetch status: {status}, log status: {item.get('status')}, exception: {item.get('exception')}")
        name = item["resource"]
        lines = resources.scan(spark, f"{collection_dir}/resource/{name}")
        for dataset in r["pipelines"].split(";"):
            trial = _trial(spark, name, dataset, lines, specification, pipeline_dir, endpoint["endpoint"], r["organisation"], lookups, day)
            unknown = trial.unknown().count()
            if unknown and confirm(f"{unknown} unknown entities in {dataset}: assign entities for this resource?"):
                low, high = specification.entity_range(dataset) or (1, 1 << 62)
                assigned = assign(trial, low, high).withColumn("entity", F.col("entity").cast("string")).persist()
                lookups = lookups.unionByName(assigned, allowMissingColumns=True).na.fill("")
                trial = _trial(spark, name, dataset, lines, specification, pipeline_dir, endpoint["endpoint"], r["organisation"], lookups, day)
                trial.assigned = assigned
                if left := trial.unknown().count():
                    raise ValueError(f"{left} unknown entities remain in resource {name} after assigning entities")
            out.trials.append(trial)
    return out


def column_field_summary(trial: Trial, headers: list[str], specification: Specification) -> dict[str, list]:
    """Which columns were bound to which fields, and what was left over on either side; a reference is a must."""
    bound = trial.transformed.columns
    generated = {*GENERATED, *([] if trial.dataset == "tree" else ["point"])}
    wanted = [f for f in specification.current_fields(trial.dataset) if f not in generated]
    if "reference" not in bound.values():
        raise ValueError("Reference not found in the mapped fields - does this need mapping?")
    return {"mapped": sorted(bound.items()), "unmapped_columns": [h for h in headers if h not in bound], "unmapped_fields": [f for f in wanted if f not in bound.values()]}


def entity_summary(trial: Trial, organisation: str) -> DataFrame:
    """One row: entities in the resource, new ones, and those of the organisation's lookups that the resource lacks."""
    own = trial.transformed.facts.select(F.col("entity").cast("string").alias("entity")).distinct()
    told = trial.lookups.where((q("prefix") == trial.dataset) & (q("organisation") == organisation)).select(q("entity").cast("string").alias("entity")).distinct()
    return (
        own.agg(F.count("*").alias("existing"))
        .crossJoin(trial.unknown().agg(F.count("*").alias("new")))  # one row each
        .crossJoin(told.join(own, "entity", "left_anti").agg(F.count("*").alias("missing")))
        .crossJoin(told.agg(F.count("*").alias("provided")))
    )


def issue_summary(trial: Trial) -> DataFrame:
    """A06 of a trial."""
    return tk.issue_summary(trial.transformed.issues.withColumnRenamed("issue_type", "issue-type"))


def retirable(sources: DataFrame, endpoints: DataFrame, organisation: str, dataset: str, endpoint: str) -> DataFrame:
    """Sources of the same organisation and dataset with another endpoint that have not ended, with its address."""
    open_ = F.coalesce(q("end-date"), F.lit("")) == ""
    mine = sources.where((q("organisation") == organisation) & F.array_contains(F.split(rg.source_datasets(sources), ";"), dataset) & (F.coalesce(q("endpoint"), F.lit("")) != "") & (q("endpoint") != endpoint))
    ends = endpoints.select("endpoint", q("endpoint-url"), open_.alias("_open"))
    return mine.withColumn("_source_open", open_).join(ends, "endpoint", "left").where(F.col("_source_open") | F.coalesce("_open", F.lit(True))).select("source", "endpoint", "endpoint-url", "entry-date")


def _write(df: DataFrame, path: str, columns: list[str]) -> None:
    """A register as one file: registers are small tables that people edit."""
    text = io.StringIO()
    out = csv.writer(text)
    out.writerow(columns)
    for r in df.select(*(F.coalesce(q(c).cast("string"), F.lit("")) if c in df.columns else F.lit("") for c in columns)).toLocalIterator():
        out.writerow(r)
    with open(f"{path}.part", "w", newline="") as f:
        f.write(text.getvalue())
    os.replace(f"{path}.part", path)


def save(addition: Addition, collection_dir: str, pipeline_dir: str) -> None:
    """Write the registers, and append new lookups."""
    _write(addition.endpoints, f"{collection_dir}/endpoint.csv", rg.SCHEMAS["endpoint"])
    _write(addition.sources, f"{collection_dir}/source.csv", rg.SCHEMAS["source"])
    if any(t.assigned is not None for t in addition.trials):
        last = addition.trials[-1].lookups
        _write(last, f"{pipeline_dir}/lookup.csv", list(last.columns))
