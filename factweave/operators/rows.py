"""Row transforms (R01-R24, R31, R32, R34): from raw lines to rows of specification fields.

A row's fields are string columns; NULL means that the key is absent, '' that it is
blank. What the rules find wrong is appended to the array column ``issues`` and
exploded once at the end (``issue_rows``), so a chain of steps stays one projection.
"""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factweave.functions import dates, geo, numbers, text

ISSUE = "struct<field:string, issue_type:string, value:string, message:string>"
ISSUES = f"array<{ISSUE}>"
META = ("dataset", "resource", "line_number", "entry_number", "provider", "priority", "issues")

#: Fields that each dataset must fill (fixed values).
MANDATORY_FIELDS = {
    "article-4-direction": ["reference", "name", "document-url", "documentation-url"],
    "article-4-direction-area": ["reference", "geometry", "name", "permitted-development-rights", "article-4-direction"],
    "conservation-area": ["reference", "geometry", "name"],
    "conservation-area-document": ["reference", "name", "conservation-area", "document-url", "documentation-url", "document-type"],
    "tree-preservation-order": ["reference", "document-url", "documentation-url"],
    "tree-preservation-zone": ["reference", "geometry", "tree-preservation-order"],
    "listed-building-outline": ["reference", "geometry", "name", "listed-building"],
    "tree": ["reference", "point", "geometry", "tree-preservation-order"],
    "brownfield-land": ["OrganisationURI", "SiteReference", "SiteNameAddress", "GeoX", "GeoY"],
    "developer-agreement": ["reference"],
    "developer-agreement-contribution": ["reference"],
    "developer-agreement-transaction": ["reference"],
    "infrastructure-funding-statement": ["reference"],
    "plan-timetable": ["reference", "plan", "plan-event", "event-date", "entry-date"],
    "local-plan": ["reference", "name", "description", "dataset", "period-start-date", "local-planning-authorities", "documentation-url", "entry-date"],
    "supplementary-plan": ["reference", "name", "description", "dataset", "period-start-date", "local-planning-authorities", "documentation-url", "entry-date"],
    "minerals-plan": ["reference", "name", "description", "dataset", "period-start-date", "minerals-and-waste-planning-authorities", "documentation-url", "document-count", "entry-date"],
    "waste-plan": ["reference", "name", "description", "dataset", "period-start-date", "minerals-and-waste-planning-authorities", "documentation-url", "document-count", "entry-date"],
}


def q(name: str) -> Column:
    """A column whose name may hold dots or hyphens."""
    return F.col(f"`{name}`")


def no_issues() -> Column:
    return F.array().cast(ISSUES)


def issue(field, kind, value, message="") -> Column:
    cells = [x if isinstance(x, Column) else F.lit(x) for x in (field, kind, value, message)]
    return F.struct(*(c.cast("string").alias(n) for c, n in zip(cells, ("field", "issue_type", "value", "message")))).cast(ISSUE)


def add_issues(df: DataFrame, *found: Column) -> DataFrame:
    """Append issues (structs, null where there is none)."""
    if not found:
        return df
    held = F.coalesce(F.col("issues"), no_issues()) if "issues" in df.columns else no_issues()
    return df.withColumn("issues", F.concat(held, F.filter(F.array(*found), lambda x: x.isNotNull())))


def issue_rows(df: DataFrame) -> DataFrame:
    """One row for each issue of a row, with where it was found."""
    held = [c for c in ("dataset", "resource", "line_number", "entry_number") if c in df.columns]
    entity = [q("entity")] if "entity" in df.columns else []
    return df.select(*held, *entity, F.explode("issues").alias("i")).select(*held, *(["entity"] if entity else []), "i.*")


def fields_of(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in META]


# ---- lines and headers ----


def normalise_lines(lines: DataFrame, skip_patterns: list[str] = ()) -> DataFrame:
    """Clean the cells of ``line``; drop blank lines, and those whose comma-joined cells start with a skip pattern."""
    lines = lines.withColumn("line", F.transform("line", text.clean_cell))
    lines = lines.where(F.array_join("line", "") != "")
    if skip_patterns:
        skipped = F.lit(False)
        for p in skip_patterns:
            skipped = skipped | F.array_join("line", ",").rlike(f"^(?:{p})")
        lines = lines.where(~skipped)
    return lines


def parse_lines(lines: DataFrame) -> DataFrame:
    """The first line of each resource names the cells of the others; entries are numbered from 1.

    Lines longer than the header lose their last cells, shorter ones have fewer keys; of two equal headers the later wins.
    """
    order = Window.partitionBy("resource").orderBy("line_number")
    first = lines.groupBy("resource").agg(F.min_by("line", "line_number").alias("header"), F.min("line_number").alias("_first"))
    rest = lines.join(first, "resource").where("line_number > _first")
    n = F.least(F.size("header"), F.size("line"))
    last = F.filter(F.slice("header", 1, n), lambda h, i: ~F.array_contains(F.slice(F.col("header"), i + 2, F.greatest(n - i - 1, F.lit(0))), h))
    cell = F.transform(last, lambda h: F.element_at(F.col("line"), (n - F.array_position(F.reverse(F.slice("header", 1, n)), h) + 1).cast("int")))
    rest = rest.withColumn("row", F.map_from_arrays(last, cell))
    return rest.withColumn("entry_number", F.row_number().over(order).cast("bigint")).drop("line", "header", "_first")


def concat_fields(row: DataFrame, concats: dict[str, dict]) -> DataFrame:
    """``{field: {fields, separator, prepend, append}}``; non-empty parts joined, applied even when there are none."""
    for field, rule in concats.items():
        own = [F.nullif(q(field), F.lit(""))] if field in row.columns else []
        others = [F.when(text.strip(q(f)) != "", q(f)) for f in rule["fields"] if f in row.columns]
        joined = F.concat_ws(rule.get("separator", ""), *own, *others) if own or others else F.lit("")
        row = row.withColumn(field, F.concat(F.lit(rule.get("prepend", "")), joined, F.lit(rule.get("append", ""))))
    return row


def filter_rows(row: DataFrame, filters: dict[str, str]) -> DataFrame:
    """Keep rows whose filtered field starts with its pattern; of several filtered fields, only the last in column order decides."""
    named = [c for c in fields_of(row) if c in filters]
    if not named:
        return row
    keep = F.lit(True)
    for c in named:
        keep = F.when(q(c).isNull(), keep).otherwise(q(c).rlike(f"^(?:{filters[c]})"))
    return row.where(keep)


def bind_headers(headers: list[str], fieldnames: list[str], columns: dict[str, str]) -> dict[str, str]:
    """Header -> field (driver side). Explicit mappings come first, then equal names that no mapping has taken."""
    known = {text.field_name(f): f for f in fieldnames}
    bound: dict[str, str] = {}
    for h in sorted(headers):
        if (target := columns.get(text.field_name(h))) is not None:
            bound[h] = target
    taken = set(bound.values())
    for h in sorted(headers):
        name = text.field_name(h)
        if h not in bound and name in known and name not in taken:
            bound[h] = known[name]
    for own, other in (("GeoX", "Easting"), ("GeoY", "Northing")):
        if own in bound and other in bound:
            bound[own] = bound.pop(own)  # last, so that it overwrites
    return bound


def map_fields(row: DataFrame, bound: dict[str, str]) -> DataFrame:
    """Rename by ``bind_headers``; IGNORE drops a header, a later header of one field overwrites, null becomes ''."""
    out = {field: F.coalesce(q(h), F.lit("")) for h, field in bound.items() if field != "IGNORE"}
    return row.select(*(c for c in row.columns if c in META), *(v.alias(k) for k, v in out.items()))


def map_to_columns(row: DataFrame, headers: list[str]) -> DataFrame:
    """The keys of the map column ``row`` as columns; keys that a row lacks are null."""
    return row.select(*(c for c in row.columns if c != "row"), *(F.try_element_at("row", F.lit(h)).alias(h) for h in headers))


# ---- values ----


def _portable(pattern: str) -> str:
    return pattern.replace("(?P<", "(?<")


def _replacement(template: str) -> str:
    return re.sub(r"\\g<(\w+)>|\\(\d+)", lambda m: "${" + m[1] + "}" if m[1] and not m[1].isdigit() else f"${m[1] or m[2]}", template.replace("$", r"\$"))


def patched(value: Column, patches: dict[str, str]) -> Column:
    """The replacement of the first pattern that a value starts with, letter case aside; the value itself if none fits."""
    out = value
    for pattern, replacement in reversed(list(patches.items())):
        exact = value == F.lit(pattern)
        fits = value.rlike(f"(?i)^(?:{_portable(pattern)})")
        whole = F.regexp_replace(F.regexp_extract(value, f"(?i)^(?:{_portable(pattern)})", 0), f"(?is)^(?:{_portable(pattern)}).*", _replacement(replacement)) if "\\" in replacement else F.lit(replacement)
        out = F.when(exact, F.lit(replacement)).when(fits, whole).otherwise(out)
    return out


def patch(row: DataFrame, patches: dict[str, dict[str, str]]) -> DataFrame:
    """R08 for all fields: a field's own patterns, and those of the field '', which are for every field."""
    changed, found = {}, []
    for c in fields_of(row):
        rules = {**patches.get(c, {}), **patches.get("", {})}
        if rules:
            new = patched(q(c), rules)
            changed[c] = new
            found.append(F.when(new != q(c), issue(c, "patch", q(c))))
    return add_issues(row, *found).withColumns(changed) if changed else row


def category(value: Column, allowed: list[str]) -> tuple[Column, Column]:
    """The value with each ``;`` part in its allowed spelling, and the array of parts that are not allowed."""
    spelling = F.create_map(*(F.lit(x) for v in reversed(allowed) for x in (v.lower(), v))) if allowed else F.create_map().cast("map<string,string>")
    parts = F.filter(F.transform(F.split(value, ";"), text.strip), lambda v: v != "")
    key = lambda v: F.lower(F.replace(v, F.lit(" "), F.lit("-")))
    known = F.transform(parts, lambda v: F.coalesce(F.try_element_at(spelling, key(v)), v))
    bad = F.filter(parts, lambda v: F.try_element_at(spelling, key(v)).isNull())
    return F.array_join(known, ";"), bad


def harmonise_value(datatype: str, value: Column, field: str, today: Column | None = None) -> tuple[Column, Column]:
    """The normalised value of a datatype, and an array of issues."""
    none = no_issues()
    blank = F.coalesce(value, F.lit("")) == ""

    def guarded(result: Column, issues: Column):
        return F.when(value.isNull(), None).when(blank, "").otherwise(result), F.when(blank, none).otherwise(issues)

    def one(kind: Column, bad: Column, message) -> Column:
        return F.when(kind.isNotNull(), F.array(issue(field, kind, bad, message))).otherwise(none)

    if datatype in ("string", "text", "hash", "reference"):
        return guarded(text.normalise_string(value), none)
    if datatype == "address":
        return guarded(text.normalise_address(value), none)
    if datatype == "flag":
        flag = text.normalise_flag(value)
        return guarded(F.coalesce(flag, F.lit("")), one(F.when(flag.isNull(), "invalid flag"), F.lower(text.strip(value)), f"{field} must be yes or no"))
    if datatype in ("url", "uri"):
        url = text.normalise_url(value)
        return guarded(F.coalesce(url, F.lit("")), one(F.when(url.isNull(), "invalid URI"), value, f"{field} must be a real URL"))
    if datatype in ("curie", "json"):
        return guarded(value, none)
    if datatype in ("multipolygon", "point", "wkt"):
        found = geo.geometry_udf(datatype)(F.when(~blank, value))
        return guarded(found["value"], F.transform(found["issues"], lambda i: issue(field, i["issue"], i["issue_value"], i["message"])))
    if datatype == "datetime":
        found = dates.normalise_date(value, today)
        message = F.when(found["issue"] == "invalid date", f"{field} must be a real date").when(found["issue"] == "far-past-date", F.concat(text.strip(value), F.lit(f" is before {dates.FAR_PAST}"))).otherwise(F.concat(text.strip(value), F.lit(" is after "), dates.far_future(today).cast("string")))
        return guarded(found["value"], one(found["issue"], value, message))
    if datatype == "integer":
        found = numbers.normalise_integer(value)
        message = F.when(found["issue"] == "invalid integer", f"{field} must be a number").otherwise(f"{field} must be larger than 0")
        return guarded(found["value"], one(found["issue"], found["issue_value"], message))
    if datatype in ("decimal", "latitude", "longitude"):
        found = numbers.normalise_decimal(value) if datatype == "decimal" else numbers.normalise_coordinate(value)
        message = F.when(found["issue"] == "invalid decimal", f"{field} must be a decimal number").otherwise(f"{field} must be larger than 0.0")
        return guarded(found["value"], one(found["issue"], found["issue_value"], message))
    raise ValueError(f"unknown datatype '{datatype}'")


def harmonise(row: DataFrame, datatypes: dict[str, str], dataset: str, categories: dict[str, list[str]] | None = None, today: Column | None = None) -> DataFrame:
    """R09-R15 over all fields of a row, in one projection."""
    today = F.current_date() if today is None else today
    names = fields_of(row)
    if unknown := [c for c in names if c not in datatypes]:
        raise ValueError(f"field {unknown[0]} does not have a datatype mapping")
    raw: dict[str, Column] = {c: q(c) for c in names}
    found: list[Column] = []
    for c, allowed in (categories or {}).items():
        if c in raw:
            value, bad = category(raw[c], allowed)
            found.append(F.when(raw[c] != "", F.transform(bad, lambda v, c=c: issue(c, "invalid category value", v))))
            raw[c] = F.when(raw[c] != "", value).otherwise(raw[c])
    out: dict[str, Column] = {}
    for c in names:
        out[c], problems = harmonise_value(datatypes[c], raw[c], c, today)
        found.append(problems)
    for c in ("entry-date", "LastUpdatedDate"):
        if c in out:
            future = F.try_to_date(F.substring(out[c], 1, 10)) > today
            found.append(F.when(future, F.array(issue(c, "future entry-date", raw[c], f"{c} must be today or in the past"))))
            out[c] = F.when(future, "").otherwise(out[c])
    if {"GeoX", "GeoY"} <= set(names):
        both = F.concat(F.lit("POINT("), out["GeoX"], F.lit(" "), out["GeoY"], F.lit(")"))
        point = geo.geometry_udf("point")(both)
        found.append(F.transform(point["issues"], lambda i: issue("GeoX,GeoY", i["issue"], i["issue_value"], i["message"])))
        for k, c in enumerate(("GeoX", "GeoY"), 1):
            number = F.regexp_extract(point["value"], r"\(([-0-9.]+) ([-0-9.]+)\)", k)
            out[c] = F.when(point["value"] != "", number.try_cast("double").cast("string"))
    for c in ("organisation", "geography", "document"):
        if c in out:
            out[c] = F.when((out[c] != "") & ~out[c].contains(":"), F.concat(F.lit(f"{dataset}:"), out[c])).otherwise(out[c])
    missing = lambda c: F.coalesce(raw[c], F.lit("")) == "" if c in raw else F.lit(True)
    for c in names:
        lacks = None
        if c in ("geometry", "point"):
            lacks = missing("geometry") & missing("point")
        elif c in MANDATORY_FIELDS.get(dataset, ()):
            lacks = missing(c)
        if lacks is not None:
            found.append(F.when(lacks, F.array(issue(c, "missing value", "", f"{c} missing"))))
    if "wikipedia" in raw:
        address = raw["wikipedia"].startswith("http")
        found.append(F.when(address, F.array(issue("wikipedia", "removed URI prefix", raw["wikipedia"]))))
        out["wikipedia"] = F.when(address, text.wikipedia_reference(raw["wikipedia"])).otherwise(out["wikipedia"])
    held = F.coalesce(F.col("issues"), no_issues()) if "issues" in row.columns else no_issues()
    every = F.concat(held, *(F.coalesce(x, no_issues()) for x in found))
    meta = [c for c in row.columns if c in META and c != "issues"]
    return row.select(*meta, every.alias("issues"), *(v.alias(k) for k, v in out.items()))


def apply_defaults(row: DataFrame, fields: dict[str, str], values: dict[str, str]) -> DataFrame:
    """A blank field takes another field's value, then a fixed value."""
    for field, source in fields.items():
        if source in row.columns:
            own = q(field) if field in row.columns else F.lit(None).cast("string")
            fill = (F.coalesce(own, F.lit("")) == "") & (F.coalesce(q(source), F.lit("")) != "")
            row = add_issues(row, F.when(fill, issue(field, "default-field", F.lit(source))))
            row = row.withColumn(field, F.when(fill, q(source)).otherwise(own))
    for field, value in values.items():
        if not value:
            continue
        own = q(field) if field in row.columns else F.lit(None).cast("string")
        fill = F.coalesce(own, F.lit("")) == ""
        if field not in ("organisation", "entry-date"):
            row = add_issues(row, F.when(fill, issue(field, "default-value", F.lit(value))))
        row = row.withColumn(field, F.when(fill, F.lit(value)).otherwise(own))
    return row


def migrate(row: DataFrame, fieldnames: list[str], migrations: dict[str, str]) -> DataFrame:
    """Each field under its new name (``migrations``: new name -> old); ``point`` from GeoX and GeoY."""
    names, out = fields_of(row), {}
    for field in fieldnames:
        old = migrations.get(field)
        have = [q(c) for c in (old, field) if c and c in names]
        if have:
            out[field] = F.coalesce(*have)
    if {"GeoX", "GeoY"} <= set(names):
        made = F.when((q("GeoX") != "") & (q("GeoY") != ""), F.concat(F.lit("POINT("), q("GeoX"), F.lit(" "), q("GeoY"), F.lit(")")))
        out["point"] = F.coalesce(made, out["point"]) if "point" in out else made
    return row.select(*(c for c in row.columns if c in META), *(v.alias(k) for k, v in out.items()))


# ---- identity ----


def organisation_aliases(organisations: DataFrame) -> DataFrame:
    """``alias, organisation`` from ``organisation, name, opendatacommunities-uri, statistical-geography, entity`` (columns that are there)."""
    code = q("organisation")
    parts = [code, F.replace(code, F.lit("local-authority-eng:"), F.lit("local-authority:"))]
    if "name" in organisations.columns:
        parts.append(q("name"))
    if "opendatacommunities-uri" in organisations.columns:
        uri = text.lower_uri(F.coalesce(q("opendatacommunities-uri"), F.lit("")))
        bare = F.regexp_replace(uri, "^https?://", "")
        for scheme in ("http://", "https://"):
            for pair in (("/id/", "/doc/"), ("/doc/", "/id/"), ("", "")):
                parts.append(F.when(bare != "", F.concat(F.lit(scheme), F.replace(bare, F.lit(pair[0]), F.lit(pair[1])) if pair[0] else bare)))
        parts.append(F.when(bare != "", text.uri_basename(bare)))
    if "statistical-geography" in organisations.columns:
        parts.append(q("statistical-geography"))
    alias = organisations.select(F.explode(F.array(*(F.lower(F.coalesce(p, F.lit(""))) for p in parts))).alias("alias"), code.alias("code"))
    return alias.where("alias <> ''").groupBy("alias").agg(F.max("code").alias("found_organisation"))


def resolve_organisation(row: DataFrame, aliases: DataFrame) -> DataFrame:
    """The code of the organisation that a row names; an unknown one becomes '' with an issue."""
    value = F.coalesce(q("organisation"), F.lit(""))
    key = F.regexp_replace(text.lower_uri(value), r"^.*/(id|doc)/[^/]*/(?=[^/]+$)", "")
    both = row.withColumn("_plain", F.lower(text.strip(value))).withColumn("_base", key)
    by_name = aliases.select(F.col("alias").alias("_plain"), F.col("found_organisation").alias("_by_name"))
    by_base = aliases.select(F.col("alias").alias("_base"), F.col("found_organisation").alias("_by_base"))
    both = both.join(by_name, "_plain", "left").join(by_base, "_base", "left")
    found = F.when(value == "", "").otherwise(F.coalesce("_by_name", "_by_base", F.lit("")))
    both = add_issues(both, F.when((value != "") & (found == ""), issue("organisation", "invalid organisation", value)))
    return both.withColumn("organisation", found).drop("_plain", "_base", "_by_name", "_by_base")


def prune_fields(row: DataFrame, fieldnames: list[str]) -> DataFrame:
    """Fields of the schema, and what identifies an entry."""
    keep = {*fieldnames, "entity", "organisation", "prefix", "reference"}
    return row.select(*(q(c) for c in row.columns if c in META or c in keep))


def entry_reference(row: DataFrame, dataset: str, prefix: str) -> DataFrame:
    """Reference and prefix of an entry, from its reference, else the field named like the dataset; a CURIE brings its prefix."""
    options = [F.nullif(q(c), F.lit("")) for c in ("reference", dataset) if c in row.columns]
    parts = text.curie_parts(F.coalesce(*options, F.lit("")))
    own = [F.nullif(q("prefix"), F.lit(""))] if "prefix" in row.columns else []
    out = F.coalesce(*own, F.nullif(parts["prefix"], F.lit("")), F.lit(prefix or dataset))
    return row.withColumns({"reference": parts["reference"], "prefix": out})


def prune_entries(row: DataFrame) -> DataFrame:
    """Entries that have an entity."""
    return row.where(F.coalesce(q("entity"), F.lit("")) != "")


# ---- conditions ----


def condition(spec: dict | list[dict] | None) -> Column:
    """``{field: value}``, ``{field: {op, value}}``, all of a dict, any of a list; values are compared trimmed."""
    if not spec:
        return F.lit(True)
    if isinstance(spec, list):
        return functools.reduce(operator.or_, map(condition, spec))

    def single(field: str, rule) -> Column:
        op, value = (rule.get("op", "="), rule.get("value")) if isinstance(rule, dict) else ("in" if isinstance(rule, list) else "=", rule)
        cell = F.trim(F.coalesce(q(field), F.lit("")))
        if op in ("=", "=="):
            return cell == str(value).strip()
        if op in ("!=", "<>"):
            return cell != str(value).strip()
        if op in ("in", "not in"):
            inside = cell.isin([str(v).strip() for v in value])
            return inside if op == "in" else ~inside
        raise ValueError(f"unsupported operator '{op}'")

    return functools.reduce(operator.and_, (single(f, r) for f, r in spec.items()))


def member(column: str, value: str, separator: str = ";") -> Column:
    """Whether a ``;`` list holds a value."""
    return F.array_contains(F.transform(F.split(F.coalesce(q(column), F.lit("")), separator), F.trim), value)


def field_list(df: DataFrame, fields: str | list[str]) -> list[str]:
    """A list of columns from a name, a comma-joined text or a list; unknown names raise."""
    names = fields.split(",") if isinstance(fields, str) else list(fields)
    names = list(dict.fromkeys(n.strip() for n in names if n.strip()))
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"unknown columns {missing}")
    return names
