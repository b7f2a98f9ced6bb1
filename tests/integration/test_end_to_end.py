import datetime as dt
import json
import sqlite3
import zipfile

import pytest
from pyspark.sql import functions as F

from factweave.plans import package, resource
from factweave.rules import RuleTables
from factweave.sources import collect, registers, resources, sinks
from factweave.spec import Specification
from factweave.streaming import merge


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "plain.csv").write_text('﻿Name,"a,b"\nx,"line\nbreak"\n\nshort\n', encoding="utf-8")
    (d / "latin.csv").write_bytes("n\ncafé\n".encode("latin-1"))
    (d / "objects.json").write_text('[{"a": 1, "b": null}, {"b": "x", "c": 2}]')
    (d / "columns.json").write_text('{"data": [[1, "y"]], "columns": ["a", "b"]}')
    (d / "map.geojson").write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"n": 1}, "geometry": {"type": "Point", "coordinates": [0, 51]}}]}')
    (d / "map.kml").write_text('<?xml version="1.0"?><kml xmlns="http://www.opengis.net/kml/2.2"><Placemark><name>k</name><Polygon><outerBoundaryIs><LinearRing><coordinates>0,51,0 1,51,0 1,52,0 0,51,0</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark></kml>')
    (d / "page.html").write_text("<!doctype html><html></html>")
    (d / "empty.csv").write_text("")
    with zipfile.ZipFile(d / "one.zip", "w") as z:
        z.writestr("in/x.json", '[{"z": 1}]')
    db = sqlite3.connect(d / "t.gpkg")
    db.execute("create table t (a text, b integer)")
    db.execute("insert into t values ('g', 3)")
    db.commit()
    db.close()
    return d


def test_scan_of_all_formats(spark, folder):
    got = {}
    for r in resources.scan(spark, str(folder)).orderBy("resource", "line_number").collect():
        got.setdefault(r["resource"], []).append(r["line"])
    assert got["plain"] == [["Name", "a,b"], ["x", "line\nbreak"], [], ["short"]]
    assert got["latin"] == [["n"], ["café"]]
    assert got["objects"] == [["a", "b"], ["1", ""], ["", "x"]] and got["columns"] == [["a", "b"], ["1", "y"]]
    assert got["map"][0] == ["WKT", "n"] or got["map"][0][0] == "WKT"
    assert got["one"] == [["z"], ["1"]] and got["t"] == [["a", "b"], ["g", "3"]]
    assert "page" not in got and "empty" not in got
    log = {r["resource"]: r["status"] for r in resources.conversions(spark, str(folder)).collect()}
    assert log["page"] == "failed" and log["plain"] == "success" and log.get("empty", "success") == "success"
    assert resources.content_addressed(spark, str(folder)).count() in (9, 10)
    broken = folder / "broken.json"
    broken.write_text('{"columns": ["a"], "data": [[1], [2], 3]}')
    assert resources.scan(spark, str(broken)).count() == 0  # no half of a file
    assert resources.conversions(spark, str(broken)).first()["status"] == "failed"
    assert list(resources._whole(iter([[str(i)] for i in range(250_000)]))) == [[str(i)] for i in range(250_000)]
    assert resources.numbered_csv(spark, str(folder / "latin.csv")).first()["n"] == "café"


SPEC = Specification({
    "field": [{"field": f, "datatype": t, "typology": y} for f, t, y in [("reference", "string", "value"), ("name", "string", "value"), ("amount", "decimal", "value"), ("entry-date", "datetime", "value"), ("organisation", "curie", "organisation"), ("entity", "integer", "value"), ("prefix", "string", "value"), ("point", "point", "value"), ("area", "curie", "geography"), ("notes", "text", "value")]],
    "dataset-field": [{"dataset": "thing", "field": f} for f in ("reference", "name", "amount", "entry-date", "organisation", "entity", "prefix", "point", "area", "notes")],
    "dataset": [{"dataset": "thing", "prefix": "thing", "entity-minimum": "1", "entity-maximum": "1000"}],
})


def transformed(spark, folder, providers=("o:1",)):
    (folder / "thing.csv").write_text("Ref,Name,Adress amount,date,point,area\nT/1,One,\"1,000.50\",31/01/2020,POINT (0 51),area:7\nT/2,Two,x,2020-02-01,,\nT/9,Lost,1,2020-02-01,,\n")
    lines = resources.scan(spark, str(folder / "thing.csv"))
    rules = RuleTables({"column": [{"column": "Ref", "field": "reference"}, {"column": "date", "field": "entry-date"}, {"column": "Adress amount", "field": "amount"}], "default-value": [{"field": "notes", "value": "none"}]}, "thing").resolve()
    lookups = spark.createDataFrame([("", "thing", "t1", "", "11"), ("", "thing", "t2", "o:1", "12"), ("", "area", "7", "", "70")], "`entry-number` string, prefix string, reference string, organisation string, entity string")
    old = spark.createDataFrame([("99", "410", "")], "`old-entity` string, status string, entity string")
    return resource.transform(lines, SPEC, "thing", rules, lookups, old, organisations=spark.createDataFrame([("o:1", "Org One")], "organisation string, name string"), providers=providers)


def test_resource_to_entities(spark, tmp_path):
    out = transformed(spark, tmp_path)
    assert out.columns["Ref"] == "reference"
    facts = out.facts.persist()
    got = {(r["entity"], r["field"]): r for r in facts.collect()}
    assert got[11, "amount"]["value"] == "1000.5" and got[11, "entry-date"]["value"] == "2020-01-31" and got[12, "name"]["value"] == "Two"
    assert (12, "amount") not in got and got[11, "area"]["reference_entity"] == 70 and got[11, "organisation"]["value"] == "o:1"
    assert got[11, "notes"]["value"] == "none" and facts.select("fact").distinct().count() == facts.count()
    kinds = {(r["entry_number"], r["issue_type"]) for r in out.issues.collect()}
    assert (2, "invalid decimal") in kinds and (3, "unknown entity") in kinds and (1, "default-value") in kinds
    built = package.build(facts, "thing", "geography")
    entities = {r["entity"]: r for r in built.entities.collect()}
    assert set(entities) == {11, 12} and entities[11]["name"] == "One" and json.loads(entities[11]["json"])["amount"] == "1000.5"
    path = str(tmp_path / "package")
    sinks.save_package("thing", path, built.facts, built.fact_resources, built.entities)
    again = package.Package(spark.read.parquet(f"{path}/fact"), spark.read.parquet(f"{path}/fact_resource"), spark.read.parquet(f"{path}/entity"))
    assert again.facts.count() == facts.count() and again.entities.count() == 2
    sinks.export_sqlite(str(tmp_path / "p.sqlite3"), {"entity": built.entities, "fact": built.facts}, {"entity": "entity", "fact": "fact"})
    assert sqlite3.connect(tmp_path / "p.sqlite3").execute("select count(*), min(entity) from entity").fetchall() == [(2, 11)]
    sinks.save_flattened(built.entities, str(tmp_path / "flat"))
    flat = registers.read_csv(spark, str(tmp_path / "flat/csv"))
    assert "organisation-entity" in flat.columns and "amount" in flat.columns
    feature = json.loads(spark.read.text(str(tmp_path / "flat/geojson")).orderBy("value").first()[0])
    assert feature["type"] == "Feature"


def test_fan_out_keeps_unresolved_once(spark, tmp_path):
    out = transformed(spark, tmp_path, providers=("o:1", "o:2"))
    got = {(r["entry_number"], r["entity"], r["organisation"]) for r in out.harmonised.collect()}
    assert got == {(1, "11", "o:1"), (2, "12", "o:1"), (3, "", "")}


def test_empty_resource_and_merge(spark, tmp_path):
    path, ckpt = str(tmp_path / "state"), str(tmp_path / "ckpt")
    source = tmp_path / "facts"
    schema = "fact string, entry_date string, value string"
    for day, rows in (("2020", [("a", "2020", "1"), ("b", "2020", "1")]), ("2021", [("a", "2021", "2"), ("b", "2019", "0")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        merge.merge_newest(merge.stream_files(spark, str(source), schema), path, ["fact"], ckpt).awaitTermination()
    got = {r["fact"]: r["value"] for r in merge.latest_snapshot(spark, path, 1).collect()}
    assert got == {"a": "2", "b": "1"}
    spark.createDataFrame([("a", "2022", "3")], schema).coalesce(1).write.mode("append").parquet(str(source))
    merge.merge_newest(merge.stream_files(spark, str(source), schema), path, ["fact"], ckpt).awaitTermination()
    assert {r["fact"]: r["value"] for r in merge.latest_snapshot(spark, path, 2).collect()} == {"a": "3", "b": "1"}
    kept = merge._generations(spark, path, 2)
    assert sorted(map(len, kept.values())) == [1, 2]  # only the touched bucket has a second version, and none a third


def test_stream_once_per_day(spark, tmp_path):
    source = str(tmp_path / "events")
    spark.createDataFrame([("e", dt.datetime(2020, 1, 1, 1)), ("e", dt.datetime(2020, 1, 1, 2)), ("e", dt.datetime(2020, 1, 2, 1))], "endpoint string, at timestamp").write.parquet(source)
    stream = merge.once_per_day(merge.stream_files(spark, source, "endpoint string, at timestamp"), "endpoint", "at")
    stream.writeStream.format("memory").queryName("once").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("once").count() == 2


def test_collect_from_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"timeStamp": "now", "x": 1}')
    url = f"file://{tmp_path}/a.json"
    key = __import__("hashlib").sha256(url.encode()).hexdigest()
    rows = [(key, url, "", "", ""), ("bad", url, "", "", ""), (__import__("hashlib").sha256(b"file:///none").hexdigest(), "file:///none", "", "", ""), ("old", url, "", "", "2000-01-01")]
    endpoints = spark.createDataFrame(rows, "endpoint string, `endpoint-url` string, plugin string, parameters string, `end-date` string")
    collector = collect.Collector(str(tmp_path / "store"))
    now = dt.datetime(2026, 1, 1)
    got = collector.collect(endpoints, now)
    assert list(got.values()) == [collect.OK, collect.HASH_FAILURE, collect.FAILED, collect.EXPIRED]
    assert collector.collect(endpoints, now)[key] == collect.ALREADY_FETCHED
    items = registers.read_log_items(spark, str(tmp_path / "store/log")).collect()
    assert {(r["endpoint"] == key, r["entry-date"][:10]) for r in items} == {(True, "2026-01-01"), (False, "2026-01-01")}
    due = {r["endpoint"]: r["fetch_status"] for r in collect.due(endpoints, registers.read_log_items(spark, str(tmp_path / "store/log")), "2026-01-01").collect()}
    assert due[key] == collect.ALREADY_FETCHED and due["old"] == collect.EXPIRED
    assert collect.sparql_csv({"head": {"vars": ["b", "a"]}, "results": {"bindings": [{"a": {"value": "p:1"}}]}}, "p:") == "a,b\r\n1,\r\n"
    pages = {0: [1, 2], 2: [3]}
    fetch = lambda u, log: json.dumps({"features": pages[int(__import__("re").search(r"resultOffset=(\d+)", u)[1])]}).encode()
    assert json.loads(collect.arcgis("http://x", {}, {"max_page_size": 2}, fetch))["features"] == [1, 2, 3]


def test_logs_and_typed_parquet(spark, tmp_path):
    df = spark.createDataFrame([("d", "r", "1", "x"), ("d", "s", "2", "")], "dataset string, resource string, line_number string, value string")
    sinks.save_log(df, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).where("dataset = 'd' and resource = 's'").count() == 1
    typed = registers.typed_by(spark.createDataFrame([("1", "2.5", "")], "a string, b string, c string"), {"a": "integer", "b": "decimal", "c": "integer"})
    assert [t for _, t in typed.dtypes] == ["bigint", "double", "bigint"] and typed.first()[:] == (1, 2.5, None)
    assert sinks.join_table(spark.createDataFrame([(1, "a;b;")], "k int, v string"), "k", "v").count() == 2
    assert sinks.stored(spark.createDataFrame([("1.9", "{}")], "n string, j string"), ("n",), ("j",)).first()[:] == (1, None)
    sinks.dump_lines(spark.createDataFrame([(['a"b', "c,d", "e"],)], "line array<string>"), str(tmp_path / "raw"))
    assert spark.read.text(str(tmp_path / "raw")).first()[0] == '"a""b","c,d",e'
    assert "dataset/d: transformed/d/r.parquet transformed/d/s.parquet" in sinks.makefile_rules(df)
    assert F is not None
