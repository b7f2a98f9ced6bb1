"""Quality checks over tables (Q01-Q36).

Every check is a DataFrame of what fails, and ``verdict`` turns it into
``(passed, message, details)``. ``typed_failures`` and ``summary`` evaluate any
number of column checks in one scan. Line numbers come from a column that the
source writes (``line_number``), so they hold whatever the partitioning.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factweave.functions.arrow import arrow_udf
from factweave.functions import geo, jsons
from factweave.functions.text import mapped
from factweave.operators.numbering import numbered
from factweave.operators.rows import condition, field_list, q

#: Severities from worst to least (fixed values).
SEVERITIES = ("critical", "error", "warning", "notice", "info", "debug")

COMPARISONS = {
    "equals_to": lambda a, b: a == b,
    "not_equal_to": lambda a, b: a != b,
    "greater_than": lambda a, b: a > b,
    "greater_than_or_equal_to": lambda a, b: a >= b,
    "less_than": lambda a, b: a < b,
    "less_than_or_equal_to": lambda a, b: a <= b,
}


@dataclass
class Verdict:
    """The outcome of a check."""

    passed: bool
    message: str
    details: dict = field(default_factory=dict)


def cell(name: str) -> Column:
    return F.trim(F.coalesce(q(name).cast("string"), F.lit("")))


#: A verdict's details hold at most so many failing rows, which is what the driver gathers; the message tells their number.
DETAILS = 10_000


def verdict(failures: DataFrame, good: str, bad: str, limit: int = DETAILS, by: list[str] = ()) -> Verdict:
    """A check's outcome; ``bad`` may use ``{n}``. Details hold the failing rows, by line or in the order of ``by``: all of them up to ``limit``, beyond it
    the first and how many there are. The failing rows as a table, whatever their number, are what the checks themselves return."""
    order = [c for c in (*by, "line_number", "field", "value") if c in failures.columns]
    rows = [r.asDict() for r in failures.orderBy(*order).limit(limit + 1).collect()] if order else [r.asDict() for r in failures.limit(limit + 1).collect()]
    n = len(rows) if len(rows) <= limit else failures.count()
    details = {"invalid_rows": rows[:limit]} | ({"invalid_row_count": n} if n > limit else {})
    return Verdict(n == 0, good if n == 0 else bad.format(n=n), details)


# ---- tables ----


def row_count(df: DataFrame, expected: int, comparison: str = "greater_than") -> DataFrame:
    """``actual, expected, passed``."""
    if comparison not in COMPARISONS:
        raise ValueError(f"Invalid comparison_rule: '{comparison}'. Must be one of {list(COMPARISONS)}.")
    return df.agg(F.count("*").alias("actual")).select("actual", F.lit(expected).cast("bigint").alias("expected"), COMPARISONS[comparison](F.col("actual"), F.lit(expected)).alias("passed"))


def duplicates(df: DataFrame, name: str) -> DataFrame:
    """Values that occur more than once, null included."""
    return df.groupBy(q(name).alias("value")).agg(F.count("*").alias("count")).where("count > 1")


def shared_values(df: DataFrame, one: str, two: str) -> DataFrame:
    """Non-blank values of one field that occur in the other."""
    return df.select(q(one).alias("value")).where("value <> ''").distinct().join(df.select(q(two).alias("value")).distinct(), "value", "left_semi")


def _widths(width: Column, bin_size: int) -> tuple[list[int], Column]:
    """Sizes of bins, in steps of a thousand, and the one by which a range of some width is covered with at most a thousand."""
    sizes = [bin_size * 1000**k for k in range(6) if bin_size * 1000**k < 1 << 62]
    size = F.lit(sizes[-1])
    for s in reversed(sizes[:-1]):
        size = F.when(width < s * 1000.0, F.lit(s)).otherwise(size)
    return sizes, size


def overlapping_ranges(df: DataFrame, low: str, high: str, bin_size: int = 64) -> DataFrame:
    """Pairs of ranges that overlap or touch, ``min_a, max_a, min_b, max_b``; ranges of equal minimum are no pair.

    A range is placed in the bins that it covers, which are wider for wide ranges, and looks for others by its start in the
    bins of every width. So pairs meet once, in the bin of the later range's start.
    """
    ranges = df.select(q(low).try_cast("bigint").alias("low"), q(high).try_cast("bigint").alias("high")).where("low is not null and high is not null")
    sizes, size = _widths(F.col("high").cast("double") - F.col("low"), bin_size)
    a = ranges.where("low <= high").withColumn("size", size).withColumn("bin", F.explode(F.sequence(F.floor(F.col("low") / F.col("size")), F.floor(F.col("high") / F.col("size")))))
    b = ranges.withColumn("size", F.explode(F.array(*(F.lit(s) for s in sizes)))).withColumn("bin", F.floor(F.col("low") / F.col("size")))
    a = a.select("size", "bin", F.col("low").alias("min_a"), F.col("high").alias("max_a"))
    b = b.select("size", "bin", F.col("low").alias("min_b"), F.col("high").alias("max_b"))
    return a.join(b, ["size", "bin"]).where("min_a < min_b and max_a >= min_b").drop("size", "bin")


def not_allowed(df: DataFrame, name: str, allowed: list[str]) -> DataFrame:
    """``line_number, value`` of values outside a list; the line number counts the failing rows from 2, as the check defines it."""
    failing = df.select(F.col("line_number").alias("_at"), cell(name).alias("value")).where(~F.col("value").isin(allowed))
    return numbered(failing, ["_at"], "line_number", 2).select("line_number", "value")


def blank_rows(df: DataFrame) -> DataFrame:
    """Q06: lines with nothing in any column."""
    blank = F.lit(True)
    for c in df.columns:
        if c != "line_number":
            blank = blank & (cell(c) == "")
    return df.where(blank).select("line_number")


def _outside(values: DataFrame, ranges: DataFrame, keys: list[str], bin_size: int = 1_000_000) -> DataFrame:
    """Rows of ``values`` (``value`` and keys) that no range (``low, high`` and keys) holds: an equi join on bins, then an anti join."""
    sizes, size = _widths(F.col("high").cast("double") - F.col("low"), bin_size)
    ranges = ranges.where("low <= high").distinct().withColumn("_size", size)
    ranges = ranges.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("low") / F.col("_size")), F.floor(F.col("high") / F.col("_size")))))
    asked = values.select("value", *keys).distinct().withColumn("_size", F.explode(F.array(*(F.lit(s) for s in sizes)))).withColumn("_bin", F.floor(F.col("value") / F.col("_size")))
    held = asked.join(ranges, ["_size", "_bin", *keys]).where("value between low and high").select("value", *keys).distinct()
    return values.join(held, ["value", *keys], "left_anti")


def _ranges(df: DataFrame, low: str, high: str, **keys: str) -> DataFrame:
    out = df.select(q(low).try_cast("bigint").alias("low"), q(high).try_cast("bigint").alias("high"), *(cell(c).alias(k) for k, c in keys.items()))
    out = out.where("low is not null and high is not null")
    for k in keys:
        out = out.where(F.col(k) != "")
    return out


def outside_ranges(df: DataFrame, ranges: DataFrame, low: str, high: str, fields: str | list[str], rules=None) -> DataFrame:
    """``line_number, field, value`` of numbers that no range holds."""
    names = field_list(df, fields)
    cells = F.explode(F.array(*(F.struct(F.lit(n).alias("field"), q(n).try_cast("bigint").alias("value")) for n in names))).alias("x")
    values = df.where(condition(rules)).select("line_number", cells).select("line_number", "x.field", "x.value").where("value is not null")
    return _outside(values, _ranges(ranges, low, high), []).select("line_number", "field", "value")


def outside_owned_ranges(df: DataFrame, ranges: DataFrame, low: str, high: str, name: str, dataset: str, range_dataset: str, aliases: dict[str, list[str]] | None = None, rules=None) -> DataFrame:
    """Numbers outside the ranges of their dataset and organisation; a dataset with aliases is held against these instead of itself."""
    values = df.where(condition(rules)).select("line_number", q(name).try_cast("bigint").alias("value"), cell(dataset).alias("dataset"), cell("organisation").alias("organisation"))
    values = values.where("value is not null and dataset <> '' and organisation <> ''")
    own = _ranges(ranges, low, high, dataset=range_dataset, organisation="organisation")
    turned = [(a.strip(), d.strip()) for d, many in (aliases or {}).items() for a in many if a.strip() and d.strip()]
    if turned:
        aliased = sorted({d for _, d in turned})
        by_alias: dict[str, list[str]] = {}
        for a, d in turned:
            by_alias.setdefault(a, []).append(d)
        targets = F.split(mapped({a: "\n".join(sorted(set(ds))) for a, ds in by_alias.items()}, "dataset"), "\n")
        every = F.concat(F.coalesce(targets, F.array().cast("array<string>")), F.when(F.col("dataset").isin(aliased), F.array().cast("array<string>")).otherwise(F.array("dataset")))
        own = own.withColumn("dataset", F.explode(F.array_distinct(every)))
    return _outside(values, own, ["dataset", "organisation"]).select("line_number", "value", "dataset", "organisation")


# ---- typed columns ----

#: Patterns of typed values (fixed values).
_HASH, _CURIE = r"^([a-z]+:)?[0-9a-fA-F]+$", r"^[a-z0-9-]+:[^\s:][^\s]*$"
_CURIES = r"^[a-z0-9-]+:[^\s:;][^\s;]*(;[a-z0-9-]+:[^\s:;][^\s;]*)*$"
_URL = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^\s/:?#]+(?::[0-9]+)?(?:[/?#][^\s]*)?$"
_DATE = r"^[0-9]{4,}[-/][0-9]{1,2}[-/][0-9]{1,2}$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


@arrow_udf("boolean")
def _compiles(values: pd.Series) -> pd.Series:
    def one(v):
        try:
            re.compile(v)
            return True
        except re.error:
            return False

    return values.map(one, na_action="ignore")


def _number(v: Column) -> Column:
    return F.when(v.rlike(_NUMBER), v.try_cast("double"))


def _whole(v: Column) -> Column:
    n = _number(v)
    return F.when(F.abs(n) >= 9.3e18, None).otherwise(n == F.rint(n))


def _date(v: Column) -> Column:
    return F.when(v.rlike(_DATE), F.try_to_date(F.translate(v, "/", "-"), "y-M-d")).isNotNull()


#: What a value of each type must fulfil; null (unknown) passes only where the type says so.
TYPES = {
    "integer": lambda v: _whole(v) | (_number(v).isNotNull() & _whole(v).isNull()),
    "decimal": lambda v: v.try_cast("decimal(18,3)").isNotNull(),
    "flag": lambda v: F.lower(v).isin("yes", "no", "true", "false"),
    "latitude": lambda v: _number(v).between(-90, 90),
    "longitude": lambda v: _number(v).between(-180, 180),
    "hash": lambda v: v.rlike(_HASH),
    "curie": lambda v: v.rlike(_CURIE),
    "curie_list": lambda v: v.rlike(_CURIES),
    "json": lambda v: F.try_parse_json(v).isNotNull(),
    "url": lambda v: v.rlike(_URL),
    "date": _date,
    "datetime": lambda v: _date(v) | (v.rlike(r"^[0-9]{4,}[-/][0-9]{1,2}[-/][0-9]{1,2}[ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?([zZ]|[+-][0-9]{2}(:?[0-9]{2})?)?$") & F.translate(v, "/", "-").try_cast("timestamp").isNotNull()),
    "pattern": lambda v: _compiles(v),
    "multipolygon": lambda v: geo.is_multipolygon(v),
    "point": lambda v: geo.is_point(v),
}


def typed_failures(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Q09-Q21, Q23, Q24: ``line_number, field, datatype, value`` of non-blank cells that are not of their type, all columns in one scan."""
    bad = []
    for name, kind in types.items():
        v = cell(name)
        wrong = (v != "") & ~F.coalesce(TYPES[kind](F.when(v != "", v)), F.lit(False))
        bad.append(F.when(wrong, F.struct(F.lit(name).alias("field"), F.lit(kind).alias("datatype"), v.alias("value"))))
    return df.select("line_number", F.explode(F.filter(F.array(*bad), lambda x: x.isNotNull())).alias("x")).select("line_number", "x.*")


def not_matching(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Q22: non-blank cells in which a pattern is not found."""
    if not pattern:
        raise ValueError("pattern must not be empty")
    re.compile(pattern)
    return df.select("line_number", cell(name).alias("value")).where((F.col("value") != "") & ~F.col("value").rlike(pattern))


def summary(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """One row with the number of failures of each typed column: many rules, one scan, one row to the driver."""
    counts = []
    for name, kind in types.items():
        v = cell(name)
        counts.append(F.count_if((v != "") & ~F.coalesce(TYPES[kind](F.when(v != "", v)), F.lit(False))).alias(name))
    return df.agg(*counts)


# ---- datasets ----


def columns_missing(actual: DataFrame, expected: list[str]) -> list[str]:
    """Expected columns that a table lacks, in order."""
    return [c for c in expected if c not in actual.columns]


def deleted_entities(entities: DataFrame, facts: DataFrame, fact_resources: DataFrame, active: DataFrame, organisation_entity: int) -> DataFrame:
    """Entities of an organisation that no active resource supports; of one reference, the smallest entity."""
    live = fact_resources.join(active.select("resource").distinct(), "resource", "left_semi").select("fact").distinct()
    supported = facts.join(live, "fact", "left_semi").select("entity").distinct()
    mine = entities.where(F.col("organisation_entity") == organisation_entity)
    return mine.join(supported, "entity", "left_anti").groupBy("reference").agg(F.min("entity").alias("entity"), F.min_by("name", "entity").alias("name"))


def past_event(entities: DataFrame, timetable: DataFrame, event: str, today: Column | None = None) -> DataFrame:
    """Entities of which a plan event lies before today, with the first such ``event_date``. ``timetable`` has ``json`` with plan, plan-event and actual-date."""
    today = F.current_date() if today is None else today
    events = timetable.select(jsons.value_of("json", "plan").alias("reference"), jsons.value_of("json", "plan-event").alias("event"), F.try_to_date(jsons.value_of("json", "actual-date")).alias("date"))
    first = events.where((F.col("event") == event) & (F.col("date") < today)).groupBy("reference").agg(F.min("date").alias("event_date"))
    return entities.join(first, "reference")


def required_after_event(entities: DataFrame, timetable: DataFrame, event: str, fields: list[str], today: Column | None = None) -> DataFrame:
    """Entities of which a plan event lies before today and a required field, a column or in ``json``, is missing or blank."""
    missing = F.array_compact(F.array(*(F.when(cell(f) == "", F.lit(f)) if f in entities.columns else F.when(jsons.is_blank("json", f), F.lit(f)) for f in fields)))
    past = past_event(entities, timetable, event, today)
    return past.select("entity", "reference", "event_date", F.array_join(missing, ";").alias("missing")).where("missing <> ''")


def old_entities_present(entities: DataFrame, old: DataFrame) -> DataFrame:
    """Entities that are listed as old."""
    return entities.select("entity").join(old.select(q("old_entity").alias("entity")).distinct(), "entity", "left_semi")


def blank_json_fields(entities: DataFrame, name: str) -> DataFrame:
    """Q31: entities of which a JSON field is missing or blank."""
    return entities.where(jsons.is_blank("json", name)).select("entity")


def duplicate_references(facts: DataFrame) -> DataFrame:
    """Entries whose reference comes with one entity and entry date more than once; one row per entry, its line one further."""
    refs = facts.where("field = 'reference'").select("field", "value", "entry_date", "entity", "entry_number")
    same = refs.groupBy("field", "value", "entry_date", "entity").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    hit = [refs[c].eqNullSafe(same[c]) for c in same.columns]
    return refs.join(same, hit, "left_semi").select("entity", "field", "value", "entry_number", (F.col("entry_number") + 1).alias("line_number"))


def organisation_faults(organisations: DataFrame, authorities: DataFrame | None = None) -> DataFrame:
    """Q33: ``organisation, field, value, issue, severity``: identifiers that several organisations share, and unknown or missing planning authorities."""
    ended = F.coalesce(q("end-date"), F.lit("")) != ""
    parts = []
    for name in ("entity", "wikidata", "billing-authority", "opendatacommunities-uri"):
        if name in organisations.columns:
            n = F.count("*").over(Window.partitionBy(q(name)))
            shared = organisations.where(cell(name) != "").withColumn("_n", n).where("_n > 1")
            parts.append(shared.select(q("organisation"), F.lit(name).alias("field"), cell(name).alias("value"), F.lit(f"duplicate {name}").alias("issue"), F.when(ended, "warning").otherwise("error").alias("severity")))
    name = "local-planning-authority"
    if authorities is not None and name in organisations.columns:
        known = authorities.select(q("reference").alias("_known")).distinct()
        lost = organisations.where(cell(name) != "").join(known, cell(name) == F.col("_known"), "left_anti")
        parts.append(lost.select(q("organisation"), F.lit(name).alias("field"), cell(name).alias("value"), F.lit("unknown planning authority").alias("issue"), F.when(ended, "warning").otherwise("error").alias("severity")))
        none = organisations.where((cell(name) == "") & q("organisation").startswith("local-authority"))
        parts.append(none.select(q("organisation"), F.lit(name).alias("field"), F.lit("").alias("value"), F.lit("missing planning authority").alias("issue"), F.when(ended, "notice").otherwise("warning").alias("severity")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- rules ----

_TEMPLATE = re.compile(r"\{\{\s*organisation\.([\w-]+)\s*\}\}")


def rendered(text: str, organisation: dict[str, str]) -> str:
    """a rule's text with an organisation's values filled in."""
    return _TEMPLATE.sub(lambda m: str(organisation.get(m[1], organisation.get(m[1].replace("_", "-"), ""))), text)


def scheduled(rules: list[dict], weekday: str) -> tuple[list[dict], list[dict]]:
    """Q34: rules that run on a weekday (all without a schedule), and those skipped."""
    due = [r for r in rules if not r.get("schedule") or weekday.lower() in {d.strip().lower() for d in r["schedule"].split(";")}]
    return due, [r for r in rules if r not in due]


def expanded(rule: dict, organisations: list[dict[str, str]]) -> list[dict]:
    """Q34: one rule for each organisation that it names (all of a dataset where it names a class), with its text filled in."""
    names = [n for n in rule.get("organisations", "").split(";") if n]
    if not names:
        return [rule]
    chosen = [o for o in organisations if o["organisation"] in names or o["organisation"].split(":")[0] in names]
    return [{**rule, **{k: rendered(rule.get(k, ""), o) for k in ("name", "description", "parameters")}, "organisation": o["organisation"]} for o in chosen]


#: Q35: the checks that rules name. Each takes a table and parameters and returns a Verdict.
REGISTRY = {
    "check_unique": lambda df, field: verdict(duplicates(df, field), f"all values in '{field}' are unique", f"there were {{n}} duplicate values in '{field}'"),
    "check_no_shared_values": lambda df, field_1, field_2: verdict(shared_values(df, field_1, field_2), f"no shared values between '{field_1}' and '{field_2}'", f"there were {{n}} shared values between '{field_1}' and '{field_2}'"),
    "check_no_overlapping_ranges": lambda df, min_field, max_field: verdict(overlapping_ranges(df, min_field, max_field), "no overlapping ranges found", "there were {n} overlapping ranges found"),
    "check_allowed_values": lambda df, field, allowed_values: verdict(not_allowed(df, field, allowed_values), f"all values in '{field}' are allowed", f"there were {{n}} invalid values in '{field}'"),
    "check_no_blank_rows": lambda df: verdict(blank_rows(df), "no blank rows found", "there were {n} blank rows found"),
    "expect_column_to_match_pattern": lambda df, field, pattern: verdict(not_matching(df, field, pattern), f"all values in '{field}' match pattern", f"there were {{n}} value(s) in '{field}' not matching pattern"),
    **{
        f"expect_column_to_be_{kind}": (lambda kind: lambda df, field: verdict(typed_failures(df, {field: kind}), f"all values in '{field}' have datatype '{kind}'", f"there were {{n}} invalid '{kind}' value(s) in '{field}'"))(kind)
        for kind in TYPES
    },
}


def _count_rows(df: DataFrame, expected: int, comparison_rule: str = "greater_than") -> Verdict:
    found = row_count(df, expected, comparison_rule).first()
    return Verdict(found["passed"], f"there were {found['actual']} rows found", {"actual": found["actual"], "expected": expected})


REGISTRY["count_rows"] = _count_rows


def _external(df: DataFrame, path: str) -> DataFrame:
    """A CSV file that a rule names, as text."""
    options = {"header": "true", "inferSchema": "false", "quote": '"', "escape": '"', "multiLine": "true"}
    return df.sparkSession.read.options(**options).csv(path)


def _lookup_rules(rules: dict | None):
    if rules is not None and not isinstance(rules, dict):
        raise ValueError("rules must be a dictionary or None")
    return (rules or {}).get("lookup_rules")


def _range_verdict(failing: DataFrame, name: str) -> Verdict:
    return verdict(failing, f"all values in '{name}' are within allowed ranges", "there were {n} out-of-range rows found", by=["field"])


def _within_range(df: DataFrame, field: str, external_file: str, min_field: str, max_field: str, rules: dict | None = None) -> Verdict:
    return _range_verdict(outside_ranges(df, _external(df, external_file), min_field, max_field, field, _lookup_rules(rules)), field)


def _within_owned_range(df: DataFrame, field: str, external_file: str, min_field: str, max_field: str, lookup_dataset_field: str, range_dataset_field: str, rules: dict | None = None, dataset_aliases: dict | None = None) -> Verdict:
    failing = outside_owned_ranges(df, _external(df, external_file), min_field, max_field, field, lookup_dataset_field, range_dataset_field, dataset_aliases, _lookup_rules(rules))
    return _range_verdict(failing, field)


REGISTRY["check_fields_are_within_range"] = _within_range
REGISTRY["check_field_is_within_range_by_dataset_org"] = _within_owned_range


def run_rules(df: DataFrame, rules: list[dict]) -> list[dict]:
    """Q35: run rules ``{operation, parameters, name, severity, ...}`` over one table; returns log entries. The scan is shared."""
    unknown = [r["operation"] for r in rules if r["operation"] not in REGISTRY]
    if unknown:
        raise ValueError(f"unknown operation '{unknown[0]}'")
    held = df.persist()
    try:
        out = []
        for rule in rules:
            result = REGISTRY[rule["operation"]](held, **rule.get("parameters", {}))
            out.append({k: v for k, v in rule.items() if k != "parameters"} | {"passed": str(result.passed), "message": result.message, "details": result.details})
        return out
    finally:
        held.unpersist()
