"""Command line: ``python -m factweave.cli COMMAND ...``. Each command is a thin wrapper of library functions."""

from __future__ import annotations

import argparse
import datetime as dt
import hashlib
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.operators import checkpoints, checks, registers, state
from factweave.operators.rows import q
from factweave.plans import add_data, package, resource
from factweave.rules import TABLES, RuleTables
from factweave.sources import collect, resources, sinks
from factweave.sources import registers as scans
from factweave.spec import Specification


def _table(spark: SparkSession, folder: str, name: str, schema: list[str]) -> DataFrame:
    path = f"{folder}/{name}.csv"
    if "://" in folder or os.path.exists(path):
        return scans.read_csv(spark, path)
    return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in schema))


def convert(spark, a):
    sinks.dump_lines(resources.scan(spark, a.input), a.output)


def pipeline(spark, a):
    specification = Specification.load(spark, a.specification)
    rules = RuleTables.load(spark, a.pipeline_dir, a.dataset).resolve(a.resource or "", tuple(filter(None, a.endpoints.split(";"))))
    out = resource.transform(
        resources.scan(spark, a.input), specification, a.dataset, rules,
        _table(spark, a.pipeline_dir, "lookup", registers.SCHEMAS["lookup"]), _table(spark, a.pipeline_dir, "old-entity", ["old-entity", "status", "entity"]),
        organisations=_table(spark, a.pipeline_dir, "organisation", ["organisation", "name"]),
        entity_organisations=_table(spark, a.pipeline_dir, "entity-organisation", ["dataset", "entity-minimum", "entity-maximum", "organisation"]).where(q("dataset") == a.dataset),
        providers=tuple(filter(None, a.organisations.split(";"))), entry_date=a.entry_date,
    )
    sinks.save_parquet(out.facts, f"{a.output}/transformed")
    sinks.save_log(out.issues.withColumn("dataset", F.lit(a.dataset)), f"{a.output}/issue")


def dataset_create(spark, a):
    facts = spark.read.parquet(a.input)
    organisations = _table(spark, os.path.dirname(a.organisation) or ".", "organisation", ["organisation", "entity"]) if a.organisation else None
    built = package.build(facts, a.dataset, a.typology, organisations)
    sinks.save_package(a.dataset, a.output, built.facts, built.fact_resources, built.entities)
    if a.sqlite:
        sinks.export_sqlite(a.sqlite, {"fact": built.facts, "fact_resource": built.fact_resources, "entity": built.entities}, {"fact": "fact", "entity": "entity"})


def dataset_update(spark, a):
    held = package.Package(*(spark.read.parquet(f"{a.package}/{t}/dataset={a.dataset}") for t in ("fact", "fact_resource", "entity")))
    held.entities = held.entities.withColumn("dataset", F.lit(a.dataset))
    package.update(a.output, a.dataset, a.typology, held, spark.read.parquet(a.input))


def dataset_entries(spark, a):
    sinks.save_csv(spark.read.parquet(f"{a.package}/entity"), a.output)


def dataset_entries_flattened(spark, a):
    sinks.save_flattened(spark.read.parquet(f"{a.package}/entity"), a.output)


def collect_endpoints(spark, a):
    print(json.dumps(collect.Collector(a.collection).collect(scans.read_csv(spark, a.endpoints), dt.datetime.now(dt.timezone.utc), a.refill), indent=1))


def _rollup(spark, a) -> DataFrame:
    return registers.resource_rollup(scans.read_log_items(spark, f"{a.collection}/log"), scans.read_csv(spark, f"{a.collection}/source.csv"))


def collection_save_csv(spark, a):
    """The resource register; with ``--held``, an earlier one is brought up to date."""
    sources = scans.read_csv(spark, f"{a.collection}/source.csv")
    out = _rollup(spark, a)
    if a.held:
        out = registers.merge_rollup(scans.read_csv(spark, a.held), out, sources)
    sinks.save_csv(out, a.output, registers.SCHEMAS["resource"])


def collection_list_resources(spark, a):
    for r in resources.content_addressed(spark, f"{a.collection}/resource").orderBy("resource").toLocalIterator():
        print(r["resource"])


def collection_pipeline_makerules(spark, a):
    mapped = registers.dataset_resources(_rollup(spark, a), scans.read_csv(spark, f"{a.collection}/source.csv"))
    print(sinks.makefile_rules(mapped), end="")


def operational_issue_save_csv(spark, a):
    sinks.save_csv(scans.read_operational_issues(spark, a.input), a.output, registers.SCHEMAS["operational-issue"])


def expectations_csv_checkpoint(spark, a):
    with open(a.rules) as f:
        log = checks.run_rules(resources.numbered_csv(spark, a.input), json.load(f))
    rows = [{k: v if isinstance(v, str) else json.dumps(v, default=str) for k, v in e.items()} | {"dataset": a.dataset} for e in log]
    sinks.save_log(spark.createDataFrame(rows), a.output, ("dataset",), ())
    print(json.dumps([{"operation": e["operation"], "passed": e["passed"], "message": e["message"]} for e in log], indent=1))


def retire_endpoints(spark, a):
    out = registers.retire(scans.read_csv(spark, a.input), a.key, a.keys.split(";"), a.end_date)
    sinks.save_csv(out, a.output, out.columns)


def assign_entities(spark, a):
    table = scans.read_csv(spark, a.lookups)
    out = registers.assign_entities(scans.read_csv(spark, a.input), table, a.low, a.high)
    sinks.save_csv(out, a.output, ["entity", "prefix", "organisation", "reference"])


def add_redirections(spark, a):
    held = scans.read_csv(spark, a.old_entities)
    sinks.save_csv(registers.redirections(scans.read_csv(spark, a.input), held, a.entry_date), a.output, held.columns)


def organisation_check(spark, a):
    sinks.save_csv(checks.organisation_faults(scans.read_csv(spark, a.input), scans.read_csv(spark, a.authorities) if a.authorities else None), a.output)


def save_state(spark, a):
    state.State.build(a.code, a.specification, a.collection, a.pipeline_dir, a.resources).save(a.output)


def check_state(spark, a):
    now = state.State.build(a.code, a.specification, a.collection, a.pipeline_dir, a.resources)
    if changed := state.State.load(a.state).differences(now):
        raise SystemExit(f"changed: {', '.join(changed)}")


def fetch(spark, a):
    """One address, fetched now, with its log item."""
    collector, now = collect.Collector(a.collection), dt.datetime.now(dt.timezone.utc)
    endpoint = hashlib.sha256(a.url.encode()).hexdigest()
    status = collector.fetch({"endpoint": endpoint, "endpoint-url": a.url, "plugin": a.plugin, "parameters": a.parameters}, now, refill=True)
    print(json.dumps({"fetch_status": status, **collector.item(now, endpoint)}, indent=1))


def _request(spark, a) -> DataFrame:
    return scans.read_csv(spark, a.input)


def collection_add_source(spark, a):
    """Entries for the endpoints and sources of a request, without a fetch."""
    held = {n: _table(spark, a.collection, n, registers.SCHEMAS[n]) for n in ("endpoint", "source")}
    new = add_data.entries(_request(spark, a), a.collection_name, held["endpoint"], held["source"], a.entry_date or dt.date.today().isoformat())
    both = [held[n].unionByName(df, allowMissingColumns=True) for n, df in zip(held, new)]
    add_data.save(add_data.Addition(*both), a.collection, "")


def _add(spark, a, confirm) -> add_data.Addition:
    specification = Specification.load(spark, a.specification)
    organisations = _table(spark, a.pipeline_dir, "organisation", ["organisation", "name"])
    return add_data.add(spark, _request(spark, a), a.collection_name, a.collection, a.pipeline_dir, specification, organisations, dt.datetime.now(dt.timezone.utc), confirm)


def add_data_command(spark, a):
    """A request with its reports; asks before numbers are assigned and before anything is saved, unless told ``--yes``."""
    confirm = (lambda question: True) if a.yes else (lambda question: input(f"{question} (yes/no): ") == "yes")
    done = _add(spark, a, confirm)
    for t in done.trials:
        headers = resource.headers_of(resources.scan(spark, f"{a.collection}/resource/{t.resource}"))
        organisation = t.transformed.harmonised.select("organisation").first()
        report = {"dataset": t.dataset, "resource": t.resource, "columns": add_data.column_field_summary(t, headers, Specification.load(spark, a.specification))}
        report["issues"] = [r.asDict() for r in add_data.issue_summary(t).collect()]
        report["entities"] = add_data.entity_summary(t, organisation[0] if organisation else "").first().asDict()
        print(json.dumps(report, indent=1, default=str))
    if confirm("Save changes made in this session?"):
        add_data.save(done, a.collection, a.pipeline_dir)


def add_endpoints_and_lookups(spark, a):
    """C13 without questions."""
    add_data.save(_add(spark, a, lambda question: True), a.collection, a.pipeline_dir)


def expectations_dataset_checkpoint(spark, a):
    """Q34, Q35: the rules (expect.csv) of a dataset over its package."""
    tables = {t: spark.read.parquet(f"{a.package}/{t}/dataset={a.dataset}") for t in ("entity", "fact", "fact_resource")}
    rules = [r.asDict() for r in scans.read_csv(spark, a.rules).collect()]  # a table of rules
    rules = [r for r in rules if a.dataset in (r.get("datasets") or r.get("dataset") or a.dataset).split(";")]
    organisations = [r.asDict() for r in scans.read_csv(spark, a.organisations).collect()] if a.organisations else []
    boundaries = scans.read_csv(spark, a.boundaries) if a.boundaries else None

    def boundary(lpa: str) -> str | None:
        found = boundaries.where(q("reference") == lpa).select("geometry").first() if boundaries is not None else None
        return found[0] if found else None

    context = checkpoints.Context(tables["entity"], tables["fact"], tables["fact_resource"], boundary)
    if a.active:
        active = scans.read_csv(spark, a.active)
        context.active = active.select(q("organisation_entity").cast("bigint").alias("organisation_entity"), "resource")
    if a.timetable:
        context.timetable = spark.read.parquet(a.timetable)
    asked, skipped = checkpoints.expectations(rules, organisations, a.weekday or dt.date.today().strftime("%A"))
    log = checkpoints.run(context, asked, a.dataset)
    checkpoints.save(spark, log, skipped, a.output, a.dataset)
    print(json.dumps([{k: e[k] for k in ("operation", "organisation", "passed", "message")} for e in log], indent=1))


def organisation_create(spark, a):
    """C14: the organisation table of several, one row for each organisation, the last non-blank value of each column."""
    out = None
    for n, path in enumerate(a.input.split(";")):
        part = scans.read_csv(spark, path).withColumn("_order", F.lit(n))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    merged = registers.merged_by_curie(out.na.fill(""), "organisation", "_order")
    sinks.save_csv(merged, a.output, ["organisation", *sorted(c for c in merged.columns if c != "organisation")])


def config_create(spark, a):
    """An empty configuration store with a table for each rule table."""
    for name in TABLES:
        spark.createDataFrame([], "dataset string, resource string, endpoint string").write.mode("overwrite").parquet(f"{a.output}/{name}")


def config_load(spark, a):
    """The rule tables of a folder in a configuration store, one parquet table each."""
    for name, df in scans.read_many(spark, a.pipeline_dir, TABLES).items():
        sinks.save_parquet(df, f"{a.output}/{name}")


_STATE = ("--code", "--specification", "--collection", "--pipeline-dir", "--resources")
#: Command -> (function, required options, optional options with defaults).
COMMANDS = {
    "convert": (convert, ("--input", "--output"), {}),
    "pipeline": (pipeline, ("--input", "--output", "--dataset", "--specification", "--pipeline-dir"), {"--resource": "", "--endpoints": "", "--organisations": "", "--entry-date": ""}),
    "dataset-create": (dataset_create, ("--input", "--output", "--dataset", "--typology"), {"--organisation": "", "--sqlite": ""}),
    "dataset-update": (dataset_update, ("--input", "--package", "--output", "--dataset", "--typology"), {}),
    "dataset-entries": (dataset_entries, ("--package", "--output"), {}),
    "dataset-entries-flattened": (dataset_entries_flattened, ("--package", "--output"), {}),
    "collect": (collect_endpoints, ("--endpoints", "--collection"), {"--refill": ""}),
    "collection-save-csv": (collection_save_csv, ("--collection", "--output"), {"--held": ""}),
    "collection-list-resources": (collection_list_resources, ("--collection",), {}),
    "collection-pipeline-makerules": (collection_pipeline_makerules, ("--collection",), {}),
    "operational-issue-save-csv": (operational_issue_save_csv, ("--input", "--output"), {}),
    "expectations-csv-checkpoint": (expectations_csv_checkpoint, ("--input", "--rules", "--output", "--dataset"), {}),
    "retire-endpoints-and-sources": (retire_endpoints, ("--input", "--key", "--keys", "--end-date", "--output"), {}),
    "assign-entities": (assign_entities, ("--input", "--lookups", "--low", "--high", "--output"), {}),
    "add-redirections": (add_redirections, ("--input", "--old-entities", "--entry-date", "--output"), {}),
    "organisation-check": (organisation_check, ("--input", "--output"), {"--authorities": ""}),
    "fetch": (fetch, ("--url", "--collection"), {"--plugin": "", "--parameters": ""}),
    "collection-add-source": (collection_add_source, ("--input", "--collection", "--collection-name"), {"--entry-date": ""}),
    "add-data": (add_data_command, ("--input", "--collection", "--collection-name", "--pipeline-dir", "--specification"), {"--yes": ""}),
    "add-endpoints-and-lookups": (add_endpoints_and_lookups, ("--input", "--collection", "--collection-name", "--pipeline-dir", "--specification"), {}),
    "expectations-dataset-checkpoint": (expectations_dataset_checkpoint, ("--package", "--rules", "--output", "--dataset"), {"--organisations": "", "--boundaries": "", "--active": "", "--timetable": "", "--weekday": ""}),
    "organisation-create": (organisation_create, ("--input", "--output"), {}),
    "config-create": (config_create, ("--output",), {}),
    "config-load": (config_load, ("--pipeline-dir", "--output"), {}),
    "save-state": (save_state, (*_STATE, "--output"), {}),
    "check-state": (check_state, (*_STATE, "--state"), {}),
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="factweave")
    sub = out.add_subparsers(dest="command", required=True)
    for name, (_, required, optional) in COMMANDS.items():
        p = sub.add_parser(name)
        for option in required:
            p.add_argument(option, required=True, type=int if option in ("--low", "--high") else str)
        for option, default in optional.items():
            p.add_argument(option, default=default)
    return out


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(arguments)
    COMMANDS[a.command][0](spark or SparkSession.builder.appName("factweave").getOrCreate(), a)


if __name__ == "__main__":
    main()
