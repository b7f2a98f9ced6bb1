import json

import pytest
from pyspark.sql import functions as F

from factweave import cli
from factweave.functions import text
from factweave.operators import state
from factweave.plans import add_data
from factweave.sources import collect
from factweave.sources.registers import read_csv
from factweave.spec import Specification


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_resource_to_flattened_dataset(spark, tmp_path):
    spec, rules = tmp_path / "specification", tmp_path / "pipeline"
    write(spec / "field.csv", "field,datatype,typology", "reference,string,value", "name,string,value", "notes,text,value", "entry-date,datetime,value", "organisation,curie,organisation", "entity,integer,value", "prefix,string,value")
    write(spec / "dataset.csv", "dataset,prefix,entity-minimum,entity-maximum", "thing,thing,1,100")
    write(spec / "dataset-field.csv", "dataset,field", *(f"thing,{f}" for f in ("reference", "name", "notes", "entry-date", "organisation", "entity", "prefix")))
    write(rules / "column.csv", "dataset,column,field", "thing,ref,reference")
    write(rules / "lookup.csv", "prefix,reference,organisation,entry-number,entity", "thing,a,,,7", "thing,b,,,8")
    write(rules / "organisation.csv", "organisation,name,entity", "o:1,One,1")
    write(rules / "entity-organisation.csv", "dataset,entity-minimum,entity-maximum,organisation", "thing,1,7,o:1")
    resource = write(tmp_path / "resource" / "abc.csv", "ref,name,notes", "a,Alpha,x", "b,Beta,", "c,Gamma,")
    run = lambda *args: cli.main([str(x) for x in args], spark)
    run("pipeline", "--input", resource, "--output", tmp_path / "out", "--dataset", "thing", "--specification", spec, "--pipeline-dir", rules, "--organisations", "o:1", "--entry-date", "2024-01-01")
    facts = spark.read.parquet(f"{tmp_path}/out/transformed")
    assert {(r["entity"], r["priority"]) for r in facts.select("entity", "priority").distinct().collect()} == {(7, 2), (8, 1)}
    assert spark.read.parquet(f"{tmp_path}/out/issue").where("issue_type = 'unknown entity'").count() == 1
    run("dataset-create", "--input", tmp_path / "out/transformed", "--output", tmp_path / "package", "--dataset", "thing", "--typology", "geography", "--sqlite", tmp_path / "p.sqlite3")
    run("dataset-update", "--input", tmp_path / "out/transformed", "--package", tmp_path / "package", "--output", tmp_path / "package2", "--dataset", "thing", "--typology", "geography")
    run("dataset-entries-flattened", "--package", tmp_path / "package2", "--output", tmp_path / "flat")
    flat = {r["entity"]: r for r in read_csv(spark, f"{tmp_path}/flat/csv").collect()}
    assert flat["7"]["name"] == "Alpha" and flat["7"]["notes"] == "x" and flat["7"]["quality"] == "authoritative" and flat["8"]["quality"] == "some"
    run("dataset-entries", "--package", tmp_path / "package", "--output", tmp_path / "entries")
    assert read_csv(spark, f"{tmp_path}/entries").count() == 2


def test_checkpoint_and_registers(spark, tmp_path):
    run = lambda *args: cli.main([str(x) for x in args], spark)
    table = write(tmp_path / "t.csv", "entity,kind", "1,a", "1,b")
    rules = write(tmp_path / "rules.json", json.dumps([{"operation": "check_unique", "parameters": {"field": "entity"}, "severity": "error"}]))
    run("expectations-csv-checkpoint", "--input", table, "--rules", rules, "--output", tmp_path / "log", "--dataset", "d")
    assert spark.read.parquet(f"{tmp_path}/log").first()["passed"] == "False"
    missing, table = write(tmp_path / "new.csv", "prefix,organisation,reference", "p,o,x"), write(tmp_path / "lookup.csv", "prefix,organisation,reference,entry-number,entity", "p,o,y,,5")
    run("assign-entities", "--input", missing, "--lookups", table, "--low", 1, "--high", 9, "--output", tmp_path / "assigned")
    assert read_csv(spark, f"{tmp_path}/assigned").first()["entity"] == "6"
    with pytest.raises(ValueError):
        run("retire-endpoints-and-sources", "--input", write(tmp_path / "e.csv", "endpoint,end-date", "x,"), "--key", "endpoint", "--keys", "x;y", "--end-date", "2024-01-01", "--output", tmp_path / "r")


def test_state(spark, tmp_path):
    for d in "abcd":
        write(tmp_path / d / "f.txt", d)
    args = ["--code", "1", "--specification", f"{tmp_path}/a", "--collection", f"{tmp_path}/b", "--pipeline-dir", f"{tmp_path}/c", "--resources", f"{tmp_path}/d"]
    cli.main(["save-state", *args, "--output", f"{tmp_path}/s.json"], spark)
    cli.main(["check-state", *args, "--state", f"{tmp_path}/s.json"], spark)
    write(tmp_path / "a" / "f.txt", "changed")
    with pytest.raises(SystemExit):
        cli.main(["check-state", *args, "--state", f"{tmp_path}/s.json"], spark)
    log = state.RunLog("d", "r", "1", "c", "s")
    assert not log.finish("RUNNING", f"{tmp_path}/run.json") and log.finish("COMPLETE", f"{tmp_path}/run.json") and not log.finish("ERROR", f"{tmp_path}/none/run.json")
    rows = spark.createDataFrame([("1",), (" ",), ("1",), (None,), ("2",)], "entity string")
    assert state.entity_count(rows).first()[0] == 2
    assert spark.range(1).select(text.normalise_enum(F.lit("Full Planning!"), {"full planning": "full"}), text.is_date(F.lit("2024-02-30"))).first()[:] == ("full", False)


def test_add_data(spark, tmp_path, monkeypatch, capsys):
    spec, rules, collection = tmp_path / "specification", tmp_path / "pipeline", tmp_path / "collection"
    write(spec / "field.csv", "field,datatype,typology", "reference,string,value", "name,string,value", "notes,text,value", "entry-date,datetime,value", "organisation,curie,organisation", "entity,integer,value", "prefix,string,value")
    write(spec / "dataset.csv", "dataset,prefix,collection,entity-minimum,entity-maximum", "thing,thing,things,1,100")
    write(spec / "dataset-field.csv", "dataset,field", *(f"thing,{f}" for f in ("reference", "name", "notes", "entry-date", "organisation", "entity", "prefix")))
    write(spec / "licence.csv", "licence,name", "ogl3,Open")
    write(rules / "column.csv", "dataset,column,field", "thing,ref,reference")
    write(rules / "lookup.csv", "prefix,reference,organisation,entry-number,entity", "thing,a,o:1,,7", "thing,gone,o:1,,8")
    write(rules / "organisation.csv", "organisation,name,entity", "o:1,One,1")
    data = write(tmp_path / "data.csv", "ref,name,Other", "a,Alpha,x", "b,Beta,", "c,Gamma,")
    write(collection / "endpoint.csv", "endpoint,endpoint-url,parameters,plugin,entry-date,start-date,end-date", "e0,http://old.example/x,,,2020-01-01,,")
    write(collection / "source.csv", "source,attribution,collection,documentation-url,endpoint,licence,organisation,pipelines,entry-date,start-date,end-date", "s0,,things,,e0,ogl3,o:1,thing,2020-01-01,,")
    url = "https://data.example.org/thing.csv"
    head = "pipelines,organisation,documentation-url,endpoint-url,start-date,licence,plugin"
    bad = write(tmp_path / "bad.csv", head, "other,o:9,nothing,also nothing,2020-13-01,none,", "thing,,https://a.example/b,https://a.example/b,,,")
    organisations, specification = read_csv(spark, str(rules / "organisation.csv")), Specification.load(spark, str(spec))
    faults = add_data.validate(read_csv(spark, bad), specification, organisations, "things")
    assert len(faults) == 8 and faults[-2:] == ["Licence is blank", "The organisation must not be blank"], faults
    assert add_data.validate(read_csv(spark, bad).drop("licence"), specification, organisations, "things") == ["required column (licence) not found in csv"]
    request = write(tmp_path / "import.csv", head, f"thing,o:1,https://data.example.org/about,{url},2024-01-01,ogl3,")

    def from_file(asked, log, parameters=None):
        log["status"] = "200"
        return open(data, "rb").read()

    monkeypatch.setitem(collect.PLUGINS, "", from_file)
    run = lambda *args: cli.main([str(x) for x in args], spark)
    where = ("--collection", collection, "--collection-name", "things", "--pipeline-dir", rules, "--specification", spec)
    run("add-data", "--input", request, *where, "--yes", "1")
    told = json.loads(capsys.readouterr().out)
    assert told["columns"]["mapped"] == [["name", "name"], ["ref", "reference"]] and told["columns"]["unmapped_columns"] == ["Other"]
    assert told["entities"] == {"existing": 3, "new": 0, "missing": 1, "provided": 4}
    lookup = {r["reference"]: r["entity"] for r in read_csv(spark, str(rules / "lookup.csv")).collect()}
    assert lookup == {"a": "7", "gone": "8", "b": "9", "c": "10"}
    endpoints, sources = (read_csv(spark, f"{collection}/{n}.csv") for n in ("endpoint", "source"))
    assert {r["endpoint-url"] for r in endpoints.collect()} == {"http://old.example/x", url} and sources.count() == 2
    new = endpoints.where("`endpoint-url` like 'https%'").first()["endpoint"]
    assert [r["source"] for r in add_data.retirable(sources, endpoints, "o:1", "thing", new).collect()] == ["s0"]
    with pytest.raises(ValueError):  # a second time
        run("add-endpoints-and-lookups", "--input", request, *where)
    other = write(tmp_path / "more.csv", head, "thing,o:1,https://data.example.org/about,https://data.example.org/more.csv,2024-01-01,ogl3,")
    run("collection-add-source", "--input", other, "--collection", collection, "--collection-name", "things")
    assert read_csv(spark, f"{collection}/source.csv").count() == 3
    run("fetch", "--url", url, "--collection", collection)
    assert json.loads(capsys.readouterr().out)["fetch_status"] == "OK"


def test_organisations_configuration_and_dataset_checkpoint(spark, tmp_path):
    run = lambda *args: cli.main([str(x) for x in args], spark)
    one, two = write(tmp_path / "a.csv", "organisation,name,entity", "o:1,One,1", "o:2,Two,2"), write(tmp_path / "b.csv", "organisation,name,region", "o:1,,north", "o:2,Second,")
    run("organisation-create", "--input", f"{one};{two}", "--output", tmp_path / "organisation")
    got = {r["organisation"]: r for r in read_csv(spark, str(tmp_path / "organisation")).collect()}
    assert got["o:1"]["name"] == "One" and got["o:1"]["region"] == "north" and got["o:2"]["name"] == "Second" and got["o:2"]["entity"] == "2"
    write(tmp_path / "rules" / "column.csv", "dataset,column,field", "thing,ref,reference")
    run("config-create", "--output", tmp_path / "config")
    run("config-load", "--pipeline-dir", tmp_path / "rules", "--output", tmp_path / "config")
    assert spark.read.parquet(f"{tmp_path}/config/column").first()["field"] == "reference" and spark.read.parquet(f"{tmp_path}/config/patch").count() == 0
    entities = spark.createDataFrame([(1, "POINT (0 51)", "", 7), (2, "POINT (0 51)", "", 7)], "entity long, point string, geometry string, organisation_entity long")
    for name, df in (("entity", entities), ("fact", entities.select("entity")), ("fact_resource", entities.select("entity"))):
        df.write.parquet(f"{tmp_path}/package/{name}/dataset=thing")
    rules = write(tmp_path / "expect.csv", "datasets,organisations,operation,parameters,name,severity", 'thing,,duplicate_geometry_check,"{""spatial_field"": ""point""}",points,error', 'other,,nothing,"{}",n,error')
    run("expectations-dataset-checkpoint", "--package", tmp_path / "package", "--rules", rules, "--output", tmp_path / "log", "--dataset", "thing")
    log = spark.read.parquet(f"{tmp_path}/log").first()
    assert log["passed"] == "False" and log["message"] == "There are 1 complete matches in the dataset" and log["dataset"] == "thing"
