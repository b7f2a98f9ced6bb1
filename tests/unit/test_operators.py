import random

import pytest
from pyspark.sql import functions as F

from factweave.functions import geo
from factweave.operators import checkpoints as cp
from factweave.operators import checks as ck
from factweave.operators import entities as en
from factweave.operators import facts as ft
from factweave.operators import lookups as lk
from factweave.operators import registers as rg
from factweave.operators import rows as rw
from factweave.operators import spatial as sp
from factweave.operators import tasks as tk
from factweave.operators.numbering import numbered
from factweave.rules import RuleTables
from factweave.spec import Specification


def lines(spark, *rows):
    return spark.createDataFrame([("r", i + 1, list(r)) for i, r in enumerate(rows)], "resource string, line_number long, line array<string>")


def test_lines_to_rows(spark):
    clean = rw.normalise_lines(lines(spark, ["note", "x"], [" a", "b ", "a"], ["", " ", "null"], ["1", "2"], ["3", "4", "5", "6"]), ["note"])
    rows = rw.parse_lines(clean).orderBy("entry_number").collect()
    assert [(r["entry_number"], r["row"]) for r in rows] == [(1, {"a": "1", "b": "2"}), (2, {"b": "4", "a": "5"})]


def test_header_binding():
    bound = rw.bind_headers(["Site Ref", "name", "Name", "GeoX", "Easting", "drop"], ["reference", "name", "GeoX"], {"siteref": "reference", "easting": "GeoX", "drop": "IGNORE"})
    assert bound["Site Ref"] == "reference" and bound["drop"] == "IGNORE" and "GeoX" not in bound or list(bound)[-1] == "GeoX"


def test_concat_filter_patch_default(spark):
    row = spark.createDataFrame([("x", "", "keep"), ("y", "z", "drop")], "a string, b string, c string")
    assert [r["d"] for r in rw.concat_fields(row, {"d": {"fields": ["a", "b"], "separator": "-", "prepend": "<", "append": ">"}}).collect()] == ["<x>", "<y-z>"]
    assert rw.filter_rows(row, {"a": "x", "c": "."}).count() == 2 and rw.filter_rows(row, {"c": "kee", "a": "q"}).count() == 1
    done = rw.patch(row, {"a": {"X": "big"}, "": {r"(k)eep": r"\1ept"}}).collect()
    assert [(r["a"], r["c"]) for r in done] == [("big", "kept"), ("y", "drop")] and len(done[0]["issues"]) == 2
    value, bad = rw.category(F.lit("Low risk; ;other"), ["low-Risk"])
    assert spark.range(1).select(value, F.array_join(bad, ",")).first()[:] == ("low-Risk;other", "other")


def test_harmonise(spark):
    row = spark.createDataFrame([("", "2999-01-01", "http://en.wikipedia.org/wiki/X", "5.0", "town", None)], "reference string, `entry-date` string, wikipedia string, amount string, organisation string, point string")
    kinds = {"reference": "string", "entry-date": "datetime", "wikipedia": "string", "amount": "integer", "organisation": "curie", "point": "point"}
    got = rw.harmonise(row, kinds, "conservation-area", today=F.lit("2026-01-01").cast("date")).first()
    assert got["amount"] == "5" and got["entry-date"] == "" and got["organisation"] == "town" or got["organisation"] == "conservation-area:town"
    assert {(i["field"], i["issue_type"]) for i in got["issues"]} == {("reference", "missing value"), ("entry-date", "far-future-date"), ("wikipedia", "removed URI prefix"), ("point", "missing value")}
    with pytest.raises(ValueError):
        rw.harmonise(row, {}, "x")


def test_conditions(spark):
    df = spark.createDataFrame([(" a ", 1), ("b", 2)], "x string, n int")
    assert df.where(rw.condition({"x": "a"})).count() == 1 and df.where(rw.condition([{"x": "a"}, {"n": 2}])).count() == 2 and df.where(rw.condition(None)).count() == 2
    assert df.where(rw.condition({"n": {"op": "not in", "value": [1]}})).count() == 1
    with pytest.raises(ValueError):
        rw.condition({"x": {"op": "like", "value": "a"}})
    assert rw.field_list(df, "x, n ,x") == ["x", "n"]


def test_lookup_order_range_and_issues(spark):
    rows = spark.createDataFrame([("r", 1, "p", "A/1", "o:1"), ("r", 2, "p", "A/1", "o:2"), ("r", 3, "p", "7", ""), ("r", 4, "p", "", "")], "resource string, entry_number int, prefix string, reference string, organisation string")
    table = spark.createDataFrame([("p", "a1", "o:1", "", "11"), ("p", "a1", "", "", "12"), ("p", "", "", "4", "14")], "prefix string, reference string, organisation string, `entry-number` string, entity string")
    old = spark.createDataFrame([("12", "301", "99")], "`old-entity` string, status string, entity string")
    got = {r["entry_number"]: r for r in lk.resolve_entities(rows, table, old, [{"prefix": "P", "offset": 10, "entity-minimum": 1, "entity-maximum": 20}], (1, 17)).collect()}
    assert [got[i]["entity"] for i in (1, 2, 3, 4)] == ["11", "99", "17", "14"]
    assert [i["issue_type"] for i in got[3]["issues"]] == ["entity number out of range"] and not got[1]["issues"]
    none = lk.resolve_entities(rows, table.where("entity = '0'")).collect()
    assert {r["entry_number"]: r["issues"][0]["issue_type"] for r in none} == {1: "unknown entity", 2: "unknown entity", 3: "unknown entity", 4: "unknown entity - missing reference"}


def test_wide_and_narrow_ranges(spark):
    values = spark.createDataFrame([(str(v),) for v in (5, 10**6, 10**15, 9 * 10**18)] + [("x",)], "entity string")
    ranges = spark.createDataFrame([(1, 10, "a"), (5, 9 * 10**18, "b"), (3, 4, "c")], "lo long, hi long, o string")
    got = {r["entity"]: r["matched_o"] for r in lk.range_owner(values, ranges, "entity", "lo", "hi").collect()}
    assert got == {"5": "a", str(10**6): "b", str(10**15): "b", str(9 * 10**18): "b", "x": None}


def facts(spark, *rows):
    return ft.with_hash(spark.createDataFrame([dict(zip(("entity", "field", "value", "priority", "entry_date", "entry_number", "resource"), r)) | {"end_date": "", "start_date": "", "reference_entity": ""} for r in rows], "entity long, field string, value string, priority long, entry_date string, entry_number long, resource string, end_date string, start_date string, reference_entity string"))


def test_facts_and_entities(spark):
    f = facts(spark, (1, "name", "old", 2, "2020", 1, "a"), (1, "name", "new", 2, "2021", 1, "a"), (1, "name", "low", 1, "2022", 1, "a"), (1, "name", "new", 1, "2022", 9, "b"), (2, "notes", "n", 1, "2020", 1, "b"))
    assert ft.latest_facts(f).count() == 4
    kept = ft.latest_facts(f).where("value = 'new'").first()
    assert kept["priority"] == 1 and kept["entry_date"] == "2022"
    out = {r["entity"]: r for r in en.assemble(f, "d", "t").collect()}
    assert out[1]["name"] == "new" and out[1]["quality"] == "authoritative" and out[1]["json"] is None
    assert out[2]["json"] == '{"notes":"n"}' and out[2]["quality"] == "some" and out[2]["name"] is None
    joined = ft.combine(f, {"name": ";"}).where("field = 'name'").select("value").distinct().collect()
    assert [r[0] for r in joined] == ["low;new;old"]
    assert ft.pivot_to_facts(spark.createDataFrame([(7, "x", None)], "entity int, a string, b string")).select("field", "value").collect() == [("a", "x")]


def test_upsert_keeps_held_on_ties(spark):
    held = spark.createDataFrame([("a", "1", "held"), ("b", "1", "held")], "k string, entry_date string, v string")
    new = spark.createDataFrame([("a", "1", "new"), ("b", "2", "new"), ("c", "1", "new")], "k string, entry_date string, v string")
    assert {r["k"]: r["v"] for r in ft.upsert_newest(held, new, ["k"]).collect()} == {"a": "held", "b": "new", "c": "new"}


def test_checks(spark):
    df = spark.createDataFrame([(2, "1", "15", "1e30"), (3, "10", "20", "x"), (4, "20", "30", ""), (5, "", "", None)], "line_number int, min string, max string, n string")
    assert ck.overlapping_ranges(df, "min", "max").count() == 2
    assert {(r["line_number"], r["value"]) for r in ck.typed_failures(df, {"n": "integer"}).collect()} == {(3, "x")}
    assert ck.REGISTRY["count_rows"](df, 4, "equals_to").passed and not ck.REGISTRY["count_rows"](df, 4).passed
    with pytest.raises(ValueError):
        ck.row_count(df, 1, "about")
    log = ck.run_rules(df, [{"operation": "check_unique", "parameters": {"field": "min"}, "name": "u"}, {"operation": "expect_column_to_be_integer", "parameters": {"field": "n"}}])
    assert [e["passed"] for e in log] == ["True", "False"] and log[1]["details"]["invalid_rows"][0]["line_number"] == 3
    assert ck.rendered("{{ organisation.name }} has {{organisation.x}}", {"name": "N"}) == "N has "
    due, skipped = ck.scheduled([{"schedule": "monday;friday"}, {}], "Friday")
    assert len(due) == 2 and not skipped and len(ck.expanded({"organisations": "a:1;b", "name": "{{ organisation.organisation }}"}, [{"organisation": "a:1"}, {"organisation": "b:2"}, {"organisation": "c:1"}])) == 2


def test_registers(spark):
    reg = spark.createDataFrame([("e1", ""), ("e2", "2020-01-01")], "endpoint string, `end-date` string")
    assert {r[0]: r[1] for r in rg.retire(reg, "endpoint", ["e1", "e2"], "2026-01-01").collect()} == {"e1": "2026-01-01", "e2": "2020-01-01"}
    with pytest.raises(ValueError):
        rg.retire(reg, "endpoint", ["e1", "e9"], "2026-01-01")
    table = spark.createDataFrame([("p", "", "o", "r1", "98")], "prefix string, `entry-number` string, organisation string, reference string, entity string")
    missing = spark.createDataFrame([("p", "o", "r1"), ("p", "o", "r2"), ("p", "o", "R-2"), ("p", "o", "r3")], "prefix string, organisation string, reference string")
    got = {r["reference"]: r["entity"] for r in rg.assign_entities(missing, table, 1, 99).collect()}
    assert got == {"R-2": 99, "r2": 1, "r3": 2}
    fresh = rg.new_endpoints(spark.createDataFrame([("http://a.bc/x",), ("nothing",)], "`endpoint-url` string"), reg, "2026-01-01").collect()
    assert len(fresh) == 1 and fresh[0]["entry-date"] == "2026-01-01"


def test_tasks(spark):
    out = tk.missing_field_tasks(spark, {"name"}, ["name", ["geometry", "point"], "reference"], "d", "o", "r", "2026-01-01").collect()
    assert sorted(r["details"] for r in out) == sorted(f'{{"field": "{f}", "issue_type": "missing-field"}}' for f in ("geometry", "point", "reference"))
    assert all(len(r["reference"]) == 16 for r in out)


def test_rule_precedence():
    rules = RuleTables(
        {
            "column": [{"column": "A", "field": "name"}, {"resource": "r", "column": "B", "field": "name"}, {"dataset": "other", "column": "C", "field": "x"}],
            "patch": [{"field": "f", "pattern": "g", "value": "1"}, {"field": "f", "resource": "r", "pattern": "h", "value": "2"}],
            "default-value": [{"field": "f", "value": "general"}, {"endpoint": "e", "field": "f", "value": "endpoint"}],
            "skip": [{"pattern": "a"}, {"resource": "r", "pattern": "b"}, {"resource": "q", "pattern": "c"}],
        },
        "d",
    )
    got = rules.resolve("r", ("e",))
    assert got.columns == {"b": "name"} and list(got.patches["f"]) == ["g", "h"] and got.default_values == {"f": "endpoint"} and got.skips == ["a", "b"]
    assert rules.resolve().columns == {"a": "name"} and rules.resolve().default_values == {"f": "general"}


def test_specification():
    s = Specification({"field": [{"field": "a", "parent-field": "b"}, {"field": "b", "typology": "category"}, {"field": "c", "end-date": "2000-01-01"}], "schema-field": [{"schema": "s", "field": f} for f in "abc"], "dataset": [{"dataset": "s", "prefix": "", "entity-minimum": "1", "entity-maximum": "5"}]})
    assert s.current_fields("s") == ["a", "b", "entity"] and s.typology("a") == "category" and s.prefix("s") == "s" and s.entity_range("s") == (1, 5)
    assert s.category_fields("s") == ["a", "b"] and s.intermediate_fields("s", {"a": "old"}) == ["b", "entity", "old"]


def test_verdicts_bound_their_details(spark):
    failing = spark.range(50).selectExpr("id + 2 AS line_number", "'x' AS value")
    v = ck.verdict(failing, "good", "{n} bad", limit=10)
    assert not v.passed and v.message == "50 bad" and len(v.details["invalid_rows"]) == 10 and v.details["invalid_row_count"] == 50
    assert ck.verdict(failing.limit(3), "good", "{n} bad").details == {"invalid_rows": [{"line_number": i, "value": "x"} for i in (2, 3, 4)]}


def test_numbers_of_a_whole_table(spark):
    rows = spark.range(1000).selectExpr("(id * 7919) % 1000 AS k").repartition(7)
    got = numbered(rows, [F.col("k").desc()], "n", 2).collect()
    assert sorted((r["k"], r["n"]) for r in got) == [(k, 1001 - k) for k in range(1000)]
    assert numbered(rows.where("k < 0"), ["k"], "n").count() == 0


def test_ranges_of_any_width_overlap_once(spark):
    r = random.Random(4)
    ranges = [(a, a + int(10 ** r.uniform(0, 9))) for a in (r.randrange(10**9) for _ in range(150))] + [(5, 3), (7, 7), (0, 10**15)]
    got = ck.overlapping_ranges(spark.createDataFrame(ranges, "low long, high long"), "low", "high").collect()
    want = [(*a, *b) for a in ranges for b in ranges if a[0] < b[0] and a[1] >= b[0]]
    assert sorted(map(tuple, got)) == sorted(want)


def test_areas_of_any_size_meet_once(spark):
    r = random.Random(5)
    boxes = [(x, y, x + s, y + s * r.uniform(0.5, 1)) for x, y, s in ((r.uniform(-1, 1), 51 + r.uniform(0, 1), 10 ** r.uniform(-3, 0.5)) for _ in range(120))]
    shapes = [(i, f"POLYGON (({a} {b},{c} {b},{c} {d},{a} {d},{a} {b}))", 1) for i, (a, b, c, d) in enumerate(boxes)]
    shapes += [(500, "POLYGON ((0 51,1 51,0.5 52,0 51))", 2), (501, "", 2), (502, None, 2)]  # a triangle fetches its geometry
    got = {(p["entity_a"], p["entity_b"]): (p["share_a"], p["share_b"]) for p in sp.duplicate_geometries(spark.createDataFrame(shapes, "entity int, geometry string, o int")).collect()}
    want = {}
    for i, (_, a, _) in enumerate(shapes[:121]):
        for _, b, _ in shapes[i + 1 : 121]:
            one, two = geo.parse_wkt(a), geo.parse_wkt(b)
            if (common := geo.overlap_area(one, two)) > 1e-12:
                j = next(k for k, s, _ in shapes if s == b)
                want[shapes[i][0], j] = (common / geo.area(one), common / geo.area(two))
    assert set(want) <= set(got) and all(got[k][0] < 1e-6 for k in set(got) - set(want))
    assert all(abs(got[k][n] - want[k][n]) < 1e-6 for k in want for n in (0, 1))


def test_copies_of_a_shape_meet_others_once(spark, monkeypatch):
    """Entities of one shape are one row of the grid; every pair of them comes out, whatever the chunks that they lie in."""
    square = "POLYGON (({0} 51,{1} 51,{1} 51.02,{0} 51.02,{0} 51))"
    texts = [square.format(0, 0.02), square.format(0.01, 0.03), square.format(0, 4), "POLYGON ((0 51,0.02 51,0.01 51.02,0 51))", square.format(7, 8)]
    rows = [(7 * i % 60, texts[i % 4]) for i in range(60)] + [(90, texts[4]), (7, texts[0]), (None, texts[0]), (None, texts[2])]
    met, grid = [], sp._box_pairs
    monkeypatch.setattr(sp, "CHUNK", 3)
    monkeypatch.setattr(sp, "_box_pairs", lambda shapes, cell: met.append(shapes.count()) or grid(shapes, cell))
    got = sp.duplicate_geometries(spark.createDataFrame(rows, "entity int, geometry string")).collect()
    shapes = {t: geo.parse_wkt(t) for t in texts}
    common = {(s, t): geo.overlap_area(shapes[s], shapes[t]) for s in texts for t in texts}
    want = [(a, b, round(common[s, t] / geo.area(shapes[s]), 6), round(common[s, t] / geo.area(shapes[t]), 6)) for a, s in rows for b, t in rows if a is not None and b is not None and a < b and common[s, t] > 1e-12]
    assert sorted((p["entity_a"], p["entity_b"], round(p["share_a"], 6), round(p["share_b"], 6)) for p in got) == sorted(want)
    assert met == [5]


def test_rollups_follow_the_sources(spark):
    sources = spark.createDataFrame([("e1", "o:1", "d1;d2"), ("e2", "o:2", "d2"), ("e3", "o:3", "")], "endpoint string, organisation string, pipelines string")
    schema = "resource string, bytes string, organisations string, datasets string, endpoints string, `start-date` string, `end-date` string"
    held = spark.createDataFrame([("r1", "1", "gone", "gone", "e1;e3", "2020-01-01", "2020-02-01"), ("r2", "2", "gone", "gone", "e1", "2020-01-01", "2020-02-01")], schema)
    new = spark.createDataFrame([("r2", "3", "o:2", "d2", "e2", "2021-01-01", "2021-02-01"), ("r3", "4", "o:2", "d2", "e2", "2021-01-01", "")], schema)
    got = {r["resource"]: r for r in rg.merge_rollup(held, new, sources, "2026-01-01").collect()}
    assert got["r1"]["organisations"] == "o:1;o:3" and got["r1"]["datasets"] == "d1;d2" and got["r1"]["end-date"] == "2020-02-01"
    assert got["r2"]["endpoints"] == "e1;e2" and got["r2"]["organisations"] == "o:2" and got["r2"]["start-date"] == "2020-01-01" and got["r2"]["end-date"] == "2021-02-01"
    assert got["r3"]["end-date"] == "" and got["r3"]["bytes"] == "4"
    with pytest.raises(ValueError):
        rg.merge_rollup(held, new, sources.where("endpoint <> 'e3'"), "2026-01-01").collect()
    log = spark.createDataFrame([("r", "e9", "2020-01-01", "1")], "resource string, endpoint string, `entry-date` string, bytes string")
    with pytest.raises(ValueError):
        rg.resource_rollup(log, sources, "2026-01-01", strict=True)


def test_dataset_checkpoint(spark, tmp_path):
    square = lambda x, s: f"POLYGON (({x} 51,{x + s} 51,{x + s} {51 + s},{x} {51 + s},{x} 51))"
    entities = spark.createDataFrame(
        [(1, "p1", "", square(0.0, 0.1), 7, '{"phone": " ", "organisations": "o:1"}'), (2, "p2", "POINT (0.5 51.05)", "", 7, '{"phone": "1"}'), (3, "p3", "", square(0.001, 0.1), 8, "{}")],
        "entity long, reference string, point string, geometry string, organisation_entity long, json string",
    ).withColumn("name", F.lit("n"))
    facts = spark.createDataFrame([("f1", 1), ("f2", 2), ("f3", 3)], "fact string, entity long")
    found = spark.createDataFrame([("f1", "r1"), ("f2", "r2"), ("f3", "r1")], "fact string, resource string")
    timetable = spark.createDataFrame([('{"plan": "p1", "plan-event": "proposed-plan-consultation-start", "actual-date": "2020-01-01"}',), ('{"plan": "p2", "plan-event": "proposed-plan-consultation-start", "actual-date": "2020-01-01"}',), ('{"plan": "p3", "plan-event": "other", "actual-date": "2020-01-01"}',)], "json string")
    context = cp.Context(entities, facts, found, {"L1": square(-0.5, 0.7)}.get, spark.createDataFrame([(7, "r1")], "organisation_entity long, resource string"), timetable)
    rules = [
        {"operation": "count_lpa_boundary", "name": "within {{ organisation.name }}", "organisations": "o:1", "parameters": '{"lpa": "{{ organisation.lpa }}", "expected": 1, "organisation_entity": {{ organisation.entity }}}', "severity": "error"},
        {"operation": "count_deleted_entities", "name": "deleted", "organisations": "o", "parameters": '{"expected": 0, "organisation_entity": {{ organisation.entity }}}'},
        {"operation": "duplicate_geometry_check", "name": "twice", "organisations": "", "parameters": '{"spatial_field": "geometry"}'},
        {"operation": "check_fields_required_after_plan_event", "name": "late", "parameters": '{"fields": ["phone"], "today": "2026-01-01"}'},
        {"operation": "check_columns", "name": "columns", "parameters": '{"expected": {"entity": ["entity", "lost"]}}'},
        {"operation": "duplicate_geometry_check", "name": "weekly", "schedule": "monday", "parameters": '{"spatial_field": "point"}'},
    ]
    organisations = [{"organisation": "o:1", "name": "One", "entity": "7", "lpa": "L1"}]
    asked, skipped = cp.expectations(rules, organisations, "Monday")
    assert not skipped and asked[0]["name"] == "within One"
    log = {e["name"]: e for e in cp.run(context, asked, "thing")}
    assert log["within One"]["passed"] == "True" and log["within One"]["message"] == "there were 1 entities found"
    assert log["deleted"]["passed"] == "False" and "[2]" in log["deleted"]["details"]
    assert log["twice"]["message"] == "There are 1 complete matches, 0 single matches and 0 any matches in the dataset"
    assert log["late"]["message"].startswith("1 missing values found across 2 plans") and '"organisation": "o:1"' in log["late"]["details"]
    assert log["columns"]["message"] == "0 out of 1 tables had expected columns" and log["weekly"]["passed"] == "True"
    out = str(tmp_path / "log")
    cp.save(spark, list(log.values()), [], out, "thing")
    later, skipped = cp.expectations(rules[2:3] + rules[5:], organisations, "tuesday")
    assert skipped == ["weekly"]
    cp.save(spark, cp.run(context, later, "thing"), skipped, out, "thing")
    assert sorted(r["name"] for r in spark.read.parquet(out).collect()) == ["twice", "weekly"]
    with pytest.raises(ValueError):
        cp.expectations([{"operation": "nothing", "name": "x"}], [], "monday")
    with pytest.raises(ValueError):
        cp.rule_organisations("nobody", organisations)


def test_range_checks_by_rule(spark, tmp_path):
    (tmp_path / "ranges.csv").write_text("low,high,dataset,organisation\n1,10,d,o\n20,30,e,o\n")
    df = spark.createDataFrame([(2, "5", "25", "d", "o"), (3, "15", "x", "d", "o")], "line_number int, entity string, other string, dataset string, organisation string")
    given = {"external_file": str(tmp_path / "ranges.csv"), "min_field": "low", "max_field": "high"}
    rules = [
        {"operation": "check_fields_are_within_range", "name": "a", "parameters": {"field": "entity,other", **given}},
        {"operation": "check_fields_are_within_range", "name": "b", "parameters": {"field": "entity", "rules": {"lookup_rules": {"entity": "5"}}, **given}},
        {"operation": "check_field_is_within_range_by_dataset_org", "name": "c", "parameters": {"field": "other", "lookup_dataset_field": "dataset", "range_dataset_field": "dataset", **given}},
    ]
    log = ck.run_rules(df, rules)
    assert [(e["passed"], e["message"]) for e in log] == [("False", "there were 1 out-of-range rows found"), ("True", "all values in 'entity' are within allowed ranges"), ("False", "there were 1 out-of-range rows found")]
