"""Entity and reference lookups.

Lookup tables are joined by one normalised key text; the organisations of a key
are a map in one row, so that keys with and without one need one join. A table of
at most ``BROADCAST_ROWS`` rows is broadcast, a larger one shuffled. Rules over
ranges of numbers, of which there are few, are compiled into the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factweave.functions.text import lookup_part, strip
from factweave.operators.rows import add_issues, issue, q

BROADCAST_ROWS = 200_000
#: Words that mark the organisation of a key as an owner (fixed values).
OWNERS = ("authority", "development", "government")


def lookup_key(entry_number="", prefix="", reference="", organisation="") -> Column:
    parts = [x if isinstance(x, Column) else F.lit(x) for x in (entry_number, prefix, reference, organisation)]
    return F.concat_ws(",", F.coalesce(parts[0].cast("string"), F.lit("")), *(lookup_part(p) for p in parts[1:]))


def lookup_table(lookups: DataFrame) -> DataFrame:
    """``key, found`` from ``prefix, reference, organisation, entry-number, entity`` rows; of equal keys the last by entity wins."""
    column = lambda c: F.coalesce(q(c).cast("string"), F.lit("")) if c in lookups.columns else F.lit("")
    key = lookup_key(column("entry-number"), column("prefix"), column("reference"), F.replace(column("organisation"), F.lit("local-authority-eng"), F.lit("local-authority")))
    return lookups.select(key.alias("key"), q("entity").cast("string").alias("found")).groupBy("key").agg(F.max_by("found", F.expr("try_cast(found as decimal(38,0))")).alias("found"))


def _checked(table: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """``table``, to be broadcast if it, or what it is made of and has no fewer rows, is small."""
    small = (table if source is None else source).limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(table) if small else table


def _by_organisation(table: DataFrame) -> DataFrame:
    """``base, by``: a lookup table's keys without organisation, and what each organisation ('' for none) finds there."""
    base, organisation = F.substring_index("key", ",", 3), F.substring_index("key", ",", -1)
    return table.groupBy(base.alias("base")).agg(F.map_from_entries(F.collect_list(F.struct(organisation.alias("organisation"), "found"))).alias("by"))


def _base(entry_number="", prefix="", reference="") -> Column:
    return F.substring_index(lookup_key(entry_number, prefix, reference), ",", 3)


def _joined(row: DataFrame, key: Column, table: DataFrame, name: str) -> DataFrame:
    return row.withColumn("_key", key).join(table.select(F.col("base").alias("_key"), F.col("by").alias(name)), "_key", "left").drop("_key")


def _found(by: str, organisation: Column | str) -> Column:
    return F.nullif(F.try_element_at(F.col(by), organisation if isinstance(organisation, Column) else F.lit(organisation)), F.lit(""))


def by_rule(prefix: Column, organisation: Column, reference: Column, rules: list[dict]) -> Column:
    """The number of the first rule (prefix, organisation, offset, entity-minimum, entity-maximum) that fits, as text."""
    number = F.when(strip(reference).rlike("^[+-]?[0-9]{1,18}$"), strip(reference).try_cast("bigint"))
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        candidate = number + int(rule["offset"])
        fits = (lookup_part(prefix) == lookup_part(F.lit(rule["prefix"]))) & candidate.between(int(rule["entity-minimum"]), int(rule["entity-maximum"]))
        if rule.get("organisation"):
            fits = fits & (lookup_part(organisation) == lookup_part(F.lit(rule["organisation"])))
        out = F.when(fits, candidate.cast("string")).otherwise(out)
    return out


def find_entities(row: DataFrame, lookups: DataFrame, rules: list[dict] = (), by_entry: bool = True) -> DataFrame:
    """``found`` by prefix and entry number, else prefix, organisation and reference, else prefix and reference, else a rule."""
    table = _checked(_by_organisation(lookup_table(lookups)), lookups)
    organisation = F.replace(F.coalesce(q("organisation"), F.lit("")), F.lit("local-authority-eng"), F.lit("local-authority"))
    row = _joined(row, _base("", q("prefix"), q("reference")), table, "_by")
    steps = [_found("_by", lookup_part(organisation)), _found("_by", "")]
    if by_entry:
        row = _joined(row, _base(q("entry_number"), q("prefix")), table, "_entry")
        steps.insert(0, _found("_entry", ""))
    ruled = by_rule(q("prefix"), organisation, q("reference"), list(rules))
    return row.withColumn("found", F.coalesce(*steps, ruled)).drop("_by", "_entry")


def redirect(row: DataFrame, old_entities: DataFrame, column: str = "entity") -> DataFrame:
    """Follow a 301 once; a 410 removes the entity."""
    old = old_entities.select(q("old-entity").cast("string").alias("_old"), q("status").cast("string").alias("_status"), q("entity").cast("string").alias("_new"))
    old = _checked(old.groupBy("_old").agg(F.max(F.struct("_status", "_new")).alias("_to")))
    row = row.join(old, q(column) == F.col("_old"), "left")
    moved = F.when(F.col("_to._status") == "301", F.col("_to._new")).when(F.col("_to._status") == "410", "").otherwise(q(column))
    return row.withColumn(column, moved).drop("_old", "_to")


def unknown_issue() -> Column:
    """The issue of a row without entity: with or without a reference."""
    curie = F.concat_ws(":", F.coalesce(q("prefix"), F.lit("")), F.coalesce(q("reference"), F.lit("")))
    kind = F.when(F.coalesce(q("reference"), F.lit("")) == "", "unknown entity - missing reference").otherwise("unknown entity")
    return issue("entity", kind, curie)


def resolve_entities(row: DataFrame, lookups: DataFrame, old_entities: DataFrame | None = None, rules: list[dict] = (), entity_range: tuple[int, int] | None = None) -> DataFrame:
    """J01, J02, J04 for rows with a prefix and no entity yet; what is not found gets an issue. The end of ``entity_range`` lies outside."""
    held = F.nullif(q("entity"), F.lit("")) if "entity" in row.columns else F.lit(None).cast("string")
    row = find_entities(row, lookups, rules).withColumn("_held", held)
    asked = F.col("_held").isNull() & (F.coalesce(q("prefix"), F.lit("")) != "")
    if entity_range:
        outside = asked & F.col("found").isNotNull() & ~F.col("found").try_cast("bigint").between(entity_range[0], entity_range[1] - 1)
        row = add_issues(row, F.when(outside, issue("entity", "entity number out of range", F.col("found"))))
    row = add_issues(row, F.when(asked & F.col("found").isNull(), unknown_issue()))
    row = row.withColumn("entity", F.coalesce("_held", F.when(asked, F.col("found")), F.lit(""))).drop("found", "_held")
    return redirect(row, old_entities) if old_entities is not None else row


def resolve_for_providers(row: DataFrame, lookups: DataFrame, providers: list[str], old_entities: DataFrame | None = None, rules: list[dict] = ()) -> DataFrame:
    """One row for each distinct entity that the row's organisation, or else the providers in turn, resolve.

    An entry that none resolves keeps one row, without entity and with an issue. Only ``(resource, entry_number)`` and the
    organisations are multiplied by the providers; the entry's own columns pass once.
    """
    if len(providers) <= 1:
        return resolve_entities(row, lookups, old_entities, rules)
    own = F.coalesce(q("organisation"), F.lit(""))
    tries = F.when(own != "", F.array(F.struct(F.lit(0).alias("at"), own.alias("by")))).otherwise(F.array(*(F.struct(F.lit(i).alias("at"), F.lit(p).alias("by")) for i, p in enumerate(providers))))
    asked = row.select("resource", "entry_number", q("prefix"), q("reference"), F.explode(tries).alias("_try"))
    asked = asked.select("resource", "entry_number", "prefix", "reference", F.col("_try.at").alias("at"), F.col("_try.by").alias("organisation"))
    found = find_entities(asked, lookups, rules).withColumn("entity", F.coalesce("found", F.lit("")))
    found = redirect(found, old_entities) if old_entities is not None else found
    found = found.where("entity <> ''").groupBy("resource", "entry_number", "entity").agg(F.min_by("organisation", "at").alias("_by"))
    out = row.drop("entity").join(found, ["resource", "entry_number"], "left")
    out = add_issues(out, F.when(F.col("entity").isNull(), unknown_issue()))
    return out.withColumn("organisation", F.coalesce("_by", own)).withColumn("entity", F.coalesce("entity", F.lit(""))).drop("_by")


def owned_entities(lookups: DataFrame) -> DataFrame:
    """Entities that have a key of an owning organisation."""
    owner = F.lit(False)
    for word in OWNERS:
        owner = owner | lookup_part(q("organisation")).contains(word)
    return lookups.where(owner).select(q("entity").cast("string").alias("_owned")).distinct()


def keys_by_entity(lookups: DataFrame) -> DataFrame:
    """All keys of each entity, in order."""
    return lookup_table(lookups).groupBy(F.col("found").alias("entity")).agg(F.array_sort(F.collect_list("key")).alias("keys"))


def resolve_references(facts: DataFrame, lookups: DataFrame, old_entities: DataFrame, rules: list[dict] = (), package_prefixes: dict[str, list[str]] | None = None, reported: list[str] = ()) -> DataFrame:
    """The entity that a fact's prefix and reference name: by organisation, else without one unless the entity is owned,
    else by the prefixes of a package, else by a rule. Removed entities are not used; 301 is not followed."""
    packages = package_prefixes or {}
    # An owned entity is not found without its organisation; the table leaves it out there.
    table = lookup_table(lookups).join(owned_entities(lookups), F.col("found") == F.col("_owned"), "left")
    table = table.where(F.col("_owned").isNull() | ~F.col("key").endswith(",")).drop("_owned")
    table = _checked(_by_organisation(table), lookups)
    organisation = F.replace(F.coalesce(q("organisation"), F.lit("")), F.lit("local-authority-eng"), F.lit("local-authority"))
    depth = max([0, *map(len, packages.values())])
    chosen, steps = facts, []
    for i in range(depth + 1):
        if i == 0:
            prefix = q("prefix")
        else:
            prefix = F.lit(None).cast("string")
            for k, v in packages.items():
                prefix = F.when(q("prefix") == k, v[i - 1]).otherwise(prefix) if len(v) >= i else prefix
        name = f"_by{i}"
        chosen = _joined(chosen, F.when(prefix.isNotNull(), _base("", prefix, q("reference"))), table, name)
        steps += [_found(name, lookup_part(organisation)), _found(name, "")]
    ruled = by_rule(q("prefix"), organisation, q("reference"), list(rules))
    asked = (F.coalesce(q("prefix"), F.lit("")) != "") & (F.coalesce(q("reference"), F.lit("")) != "") & (F.coalesce(q("entity").cast("string"), F.lit("")) != "")
    chosen = chosen.withColumn("_found", F.when(asked, F.coalesce(*steps, ruled))).drop(*(f"_by{i}" for i in range(depth + 1)))
    gone = _checked(old_entities.where(q("status").cast("string") == "410").select(q("old-entity").cast("string").alias("_gone")).distinct())
    chosen = chosen.join(gone, F.col("_found") == F.col("_gone"), "left")
    found = F.when(F.col("_gone").isNull(), F.col("_found"))
    told = q("prefix").isin([*reported, *packages]) if reported or packages else F.lit(False)
    chosen = add_issues(chosen, F.when(asked & told & found.isNull(), issue(q("prefix"), "missing associated entity", q("reference"))))
    return chosen.withColumn("reference_entity", found).drop("_found", "_gone")


def new_lookups(row: DataFrame, lookups: DataFrame, rules: list[dict] = ()) -> DataFrame:
    """Prefix, organisation and reference of entries that no lookup resolves."""
    missed = find_entities(row, lookups, rules).where("found is null")
    named = [F.coalesce(q(c), F.lit("")) != "" for c in ("prefix", "organisation", "reference")]
    return missed.where(named[0] & named[1] & named[2]).select("prefix", "organisation", "reference").distinct()


# ---- ranges ----


def range_owner(values: DataFrame, ranges: DataFrame, value: str, low: str, high: str, bin_size: int = 1_000_000) -> DataFrame:
    """``values`` left-joined to the first range (by low, then high) that holds them.

    Values and ranges meet in bins of numbers, so this is an equi join whatever the number of ranges. The bins of a range are
    as much wider, in steps of a thousand, as it takes to cover it with at most a thousand of them.
    """
    rest = [c for c in ranges.columns if c not in (low, high)]
    ranges = ranges.select(q(low).cast("bigint").alias("_low"), q(high).cast("bigint").alias("_high"), *(q(c).alias(f"_r_{c}") for c in rest)).where("_low <= _high")
    sizes = [bin_size * 1000**k for k in range(5) if bin_size * 1000**k < 1 << 62]
    width = F.col("_high").cast("double") - F.col("_low")
    size = F.lit(sizes[-1])
    for s in reversed(sizes[:-1]):
        size = F.when(width < s * 1000.0, F.lit(s)).otherwise(size)
    bins = F.sequence(F.floor(F.col("_low") / size), F.floor(F.col("_high") / size))
    binned = ranges.withColumn("_size", size).withColumn("_bin", F.explode(bins))
    number = q(value).try_cast("bigint")
    keyed = values.withColumn("_id", F.monotonically_increasing_id()).withColumn("_value", number)
    asked = keyed.select("_value").where("_value is not null").distinct()
    asked = asked.withColumn("_size", F.explode(F.array(*(F.lit(s) for s in sizes)))).withColumn("_bin", F.floor(F.col("_value") / F.col("_size")))
    hit = asked.join(binned, ["_size", "_bin"]).where("_value between _low and _high")
    first = hit.groupBy("_value").agg(F.min_by(F.struct("_low", "_high", *(f"_r_{c}" for c in rest)), F.struct("_low", "_high")).alias("_range"))
    out = keyed.join(first, "_value", "left")
    extra = [F.col("_range._low").alias(f"matched_{low}"), F.col("_range._high").alias(f"matched_{high}")]
    return out.select(*(q(c) for c in values.columns), *extra, *(F.col(f"_range._r_{c}").alias(f"matched_{c}") for c in rest))


def prioritise(row: DataFrame, ranges: DataFrame, providers: list[str]) -> DataFrame:
    """Priority 2 where a provider owns the entity's range; else 1, and the owner, if any, becomes the organisation."""
    out = range_owner(row, ranges.select(q("entity-minimum"), q("entity-maximum"), q("organisation").alias("owner")), "entity", "entity-minimum", "entity-maximum")
    owner = F.col("matched_owner")
    mine = owner.isin(list(providers)) if providers else F.lit(False)
    out = out.withColumn("priority", F.when(owner.isNotNull() & mine, 2).otherwise(1))
    out = out.withColumn("organisation", F.when(owner.isNotNull() & ~mine, owner).otherwise(q("organisation")))
    return out.drop("matched_owner", "matched_entity-minimum", "matched_entity-maximum")


def fill_issue_entities(issues: DataFrame, entries: DataFrame) -> DataFrame:
    """Issues with the entity of their entry; of several, the first."""
    first = entries.groupBy("resource", "entry_number").agg(F.min_by("entity", F.expr("try_cast(entity as decimal(38,0))")).alias("_entity"))
    out = issues.join(first, ["resource", "entry_number"], "left")
    own = F.nullif(q("entity"), F.lit("")) if "entity" in issues.columns else F.lit(None).cast("string")
    return out.withColumn("entity", F.coalesce(own, "_entity", F.lit(""))).drop("_entity")
