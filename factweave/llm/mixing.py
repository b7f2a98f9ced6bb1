"""Mixing sources to target weights, natively in DataFrame operations.

Each source's words, document after document in a fixed pseudorandom order, form
one stream that is cut into blocks of ``block_words`` words. An output shard has
``shard_slots`` slots, and every slot draws a source, so that a shard's source
counts are multinomial. A source's slots are numbered in the order of their
shards, mapped through pseudorandom permutations of its block indexes, one
permutation for each epoch, and joined to the blocks by index. There are at most
``max_epochs`` epochs, so no block, and so no document, is taken more often.

Plain multinomial totals scatter around their expectation by the root of the
number of slots. So the slots are drawn in phases: the first three quarters by the
targets, and each later phase (three quarters of the rest, at last the rest) by
what each source still lacks. The totals then scatter by an eighth of that root.
Which blocks are taken, and how often, follows from the totals drawn.

Cases: null text has size 0 and takes 0; a null source is a source of its own,
ordered last; repeated rows are separate documents; empty tables give no rows;
extra columns of any name are ignored (``mix``) or carried along (``mixed_documents``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factweave.llm.common import WORD, pick, stash, word_count

#: Up to this many sources, the table of sources is broadcast; beyond, it is joined by shuffle.
BROADCAST_SOURCES = 10_000
#: The share of the slots that are left which each phase but the last draws.
PHASES = (0.75, 0.75, 0.75)
#: Rounds of the index permutations.
ROUNDS = 12
#: Running sums over shards, or over buckets of documents, go by groups of so many first.
GROUP = 4096


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_SOURCES else df


def source_targets(sizes: DataFrame, weights=(1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """``source, source_size, weight, target`` from ``source, size`` rows.

    The targets share the total size by weight; a target stops at ``max_epochs``
    times its source's size and the excess goes to the others by weight. With the
    sources ordered by cap / weight the shared level has a closed form: it is the
    level of the first source that stays below its own cap. The windows run over
    one row for each source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("rank", F.row_number().over(order) - 1)
    ws = F.array(*(F.lit(float(w)) for w in weights))
    per = per.withColumn("weight", F.element_at(ws, (F.col("rank") % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    everything = Window.partitionBy(F.lit(1))
    before = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    per = (
        per.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("capped_weight", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("capped")) / (F.col("all_weight") - F.col("capped_weight")))
    )
    holds = F.col("level") * F.col("weight") <= F.col("cap")
    first = F.min(F.when(holds, F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("level")))).over(everything)
    per = per.withColumn("shared_level", F.coalesce(first["level"], F.lit(0.0)))
    return per.select("source", "source_size", "weight", F.least("cap", F.col("weight") * F.col("shared_level")).alias("target"))


def permuted(position: Column, blocks: Column, *key: Column) -> Column:
    """A pseudorandom bijection of 0..blocks-1, chosen by ``key``: a swap-or-not shuffle.

    Each round pairs x with (shift - x) modulo ``blocks`` and, by a hash of the
    pair's larger member, swaps both or neither. Nothing is multiplied, so any
    number of blocks will do.
    """
    seed = F.xxhash64(*key)

    def swap(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(seed, r), blocks) - x, blocks)
        flip = F.xxhash64(r, seed, F.greatest(x, other)).bitwiseAND(F.lit(1))
        return F.when(flip == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), position.cast("long"), swap)


def _before(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of the same source with a smaller ``order``, a long.

    Sums go by groups of ``GROUP`` orders first, so that no window holds all rows of a source.
    """
    df = df.withColumn("part", F.floor(F.col(order) / GROUP))
    sums = df.groupBy("source", "part").agg(F.sum(value).alias("words"))
    upto = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("sums_source"), F.col("part").alias("sums_part"), F.coalesce(F.sum("words").over(upto), F.lit(0)).alias("sums_base"))
    within = Window.partitionBy("source", "part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    df = df.join(sums, F.col("source").eqNullSafe(F.col("sums_source")) & (F.col("part") == F.col("sums_part")))
    return df.withColumn(name, (F.col("sums_base") + F.col("within")).cast("long")).drop("part", "within", "sums_base", "sums_source", "sums_part")


def _drawn(have: DataFrame, n_sources: int, first_slot: int, n_slots: int, shard_slots: int, seed: int) -> DataFrame:
    """``shard, source, n``: the source counts of slots ``first_slot`` and after, drawn in proportion to ``lacks``."""
    cells = max(4096, 2 * n_sources)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = have.where("lacks > 0").withColumn("high", F.sum("lacks").over(running) / F.sum("lacks").over(Window.partitionBy(F.lit(1))))
    ranges = ranges.select("source", F.coalesce(F.lag("high").over(order), F.lit(0.0)).alias("low"), F.when(F.lead("high").over(order).isNull(), 1.0).otherwise(F.col("high")).alias("high"))
    first_cell, last_cell = F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1))
    ranges = ranges.withColumn("cell", F.explode(F.sequence(first_cell.cast("long"), last_cell.cast("long"))))
    unit = F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(1 << 52)) / F.lit(float(1 << 52))
    slots = have.sparkSession.range(first_slot, first_slot + n_slots).select(F.floor(F.col("id") / shard_slots).alias("shard"), unit.alias("u"))
    slots = slots.withColumn("cell", F.floor(F.col("u") * cells))
    return slots.join(_small(ranges, n_sources + cells), "cell").where("u >= low and u < high").groupBy("shard", "source").agg(F.count("*").alias("n"))


def shard_counts(per: DataFrame, n_sources: int, n_slots: int, shard_slots: int, seed: int) -> DataFrame:
    """``shard, source, first, n``: how many blocks each shard takes of each source, and the number of its first such slot.

    ``per`` has ``source, quota`` (the expected slots, a double) and ``most`` (the slots that the epochs allow).
    """
    none = per.where("false").select(F.lit(0).cast("long").alias("shard"), "source", F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("n"))
    counts, done = none, 0
    for share in (*PHASES, 1.0):
        now = round((n_slots - done) * share)
        got = counts.groupBy("source").agg(F.sum("n").alias("got")).alias("g")
        have = per.alias("p").join(_small(got, n_sources), F.col("p.source").eqNullSafe(F.col("g.source")), "left")
        have = have.select("p.source", "quota", "most", F.coalesce("got", F.lit(0)).alias("got")).withColumn("lacks", F.greatest(F.lit(0.0), F.col("quota") - F.col("got")))
        drawn = _before(_drawn(have, n_sources, done, now, shard_slots, seed), "shard", "n", "before").alias("d")
        drawn = drawn.join(_small(have, n_sources).alias("h"), F.col("d.source").eqNullSafe(F.col("h.source")))
        drawn = drawn.select("shard", "d.source", (F.col("got") + F.col("before")).cast("long").alias("first"), "n", "most")
        # What a source has no blocks left for is drawn again in the next phase.
        drawn = drawn.withColumn("n", F.least(F.col("n"), F.col("most") - F.col("first"))).where("n > 0").drop("most")
        drawn = stash(drawn, "mix-draws")
        counts, done = (drawn if counts is none else counts.unionByName(drawn)), done + now
    return counts


def _source_plan(sizes: DataFrame, weights, max_epochs: int, block_words: int) -> DataFrame:
    per = source_targets(sizes, weights, max_epochs)
    per = per.withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
    quota = F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(F.lit(0.0))
    return stash(per.withColumn("quota", quota).withColumn("most", F.col("blocks") * max_epochs), "mix-sources")


def _sized(docs: DataFrame) -> DataFrame:
    """Equal rows of ``docs`` (``doc_id, source, text, row``) in one row: ``doc_id, source, ident, row, size, copies``."""
    rows = docs.select("doc_id", "source", F.xxhash64("doc_id", "source", "text").alias("ident"), "row", word_count(F.col("text")).alias("size"))
    return stash(rows.groupBy("doc_id", "source", "ident", "row", "size").agg(F.count("*").alias("copies")), "mix-sizes")


def _slots(counts: DataFrame, per: DataFrame, n_sources: int, seed: int) -> DataFrame:
    """``shard, source, slot, epoch, block``: one row for each block that a shard takes."""
    # A row becomes as many slots as a shard draws of a source, so few rows are a task's work.
    counts = counts.repartition(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard", "source")
    slots = counts.select("shard", "source", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot")).alias("s")
    slots = slots.join(_small(per.select("source", "blocks"), n_sources).alias("p"), F.col("s.source").eqNullSafe(F.col("p.source"))).select("s.*", "blocks")
    slots = slots.withColumn("epoch", F.floor(F.col("slot") / F.col("blocks")))
    block = permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("source"), F.col("epoch"))
    return slots.select("shard", "source", "slot", "epoch", block.alias("block"))


def _documents(docs: DataFrame) -> DataFrame:
    return pick(docs, doc_id="doc_id", text="text", source="source").withColumn("row", F.lit(0).cast("long"))


def _plan(docs: DataFrame, weights, max_epochs: int, block_words: int, shard_slots: int, seed: int):
    """The documents with their places in their source's stream, and the slots that take its blocks."""
    groups = _sized(docs)
    words = F.col("size") * F.col("copies")
    per = _source_plan(groups.select("source", words.alias("size")), weights, max_epochs, block_words)
    n_sources, n_slots = per.agg(F.count("*"), F.round(F.coalesce(F.sum("quota"), F.lit(0.0))).cast("long")).first()
    slots = _slots(shard_counts(per, n_sources, n_slots, shard_slots, seed), per, n_sources, seed)
    n_groups = groups.count()
    # A document's place is its bucket's, and then its own by order in the bucket; a hot source has many buckets.
    n_buckets = max(1, round(n_groups / max(250, n_groups**0.5)))
    groups = groups.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("ident")), F.lit(n_buckets)))
    base = _before(groups.groupBy("source", "bucket").agg(F.sum(words).alias("words")), "bucket", "words", "base").alias("b")
    within = Window.partitionBy("source", "bucket").orderBy("doc_id", "ident", "row").rowsBetween(Window.unboundedPreceding, -1)
    rows = groups.withColumn("within", F.coalesce(F.sum(words).over(within), F.lit(0))).alias("r")
    rows = rows.join(base, F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.bucket") == F.col("b.bucket")))
    rows = rows.select("r.doc_id", "r.source", "r.ident", "r.row", "r.size", "copies", (F.col("base") + F.col("within")).alias("place")).alias("r")
    rows = rows.join(_small(per, n_sources).alias("p"), F.col("r.source").eqNullSafe(F.col("p.source"))).select("r.*", "source_size", "target")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    return rows.withColumn("start", F.col("place") + F.col("copy") * F.col("size")).drop("place", "copies"), slots


def mixed_blocks(docs: DataFrame, weights=(1, 2, 3), max_epochs: int = 3, block_words: int = 32, shard_slots: int = 4096, seed: int = 42) -> DataFrame:
    """``shard, source, slot, epoch, block``: the blocks of each source's stream that every output shard takes."""
    return _plan(_documents(docs), weights, max_epochs, block_words, shard_slots, seed)[1]


def _pieces(rows: DataFrame, taken: DataFrame, block_words: int) -> DataFrame:
    """One row for each document, block it lies in (none for empty documents) and row of ``taken`` (``source, block, ...``) for that block, if any."""
    blocks = F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words))
    pieces = rows.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, blocks)))
    low = F.greatest("start", F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    pieces = pieces.withColumn("low", low - F.col("start")).withColumn("words", high - low).alias("d")
    hit = F.col("d.source").eqNullSafe(F.col("t.source")) & (F.col("d.block") == F.col("t.block"))
    return pieces.join(taken.alias("t"), hit, "left").drop(F.col("t.source"), F.col("t.block"))


def mix(docs: DataFrame, weights=(1, 2, 3), max_epochs: int = 3, block_words: int = 32, shard_slots: int = 4096, seed: int = 42) -> DataFrame:
    """``doc_id, size, source_size, target, taken, shards`` for every row of ``docs`` (``doc_id, text, source``).

    ``block_words`` is the length of blocks, and ``shards`` has the numbers of the output shards that take words of the document.
    """
    rows, slots = _plan(_documents(docs), weights, max_epochs, block_words, shard_slots, seed)
    keys = ["doc_id", "source", "ident", "copy", "size", "source_size", "target"]
    taken = F.coalesce(F.sum(F.when(F.col("shard").isNotNull(), F.col("words"))), F.lit(0)).cast("long")
    pieces = _pieces(rows, slots.select("source", "block", "shard"), block_words)
    done = pieces.groupBy(*keys).agg(taken.alias("taken"), F.array_sort(F.collect_set("shard")).alias("shards"))
    return done.select("doc_id", "size", "source_size", "target", "taken", "shards")


def mixed_documents(docs: DataFrame, weights=(1, 2, 3), max_epochs: int = 3, block_words: int = 32, shard_slots: int = 4096, seed: int = 42) -> DataFrame:
    """The mix as documents with the columns of ``docs``: one row for each copy of a document, with the words that this copy takes.

    A copy that takes all words keeps its text as it is; otherwise the taken
    words are joined by spaces. ``n_chars``, if there, is counted anew.
    """
    names = docs.columns
    work = docs.toDF(*(f"_{i}" for i in range(len(names))))
    doc_id, text, source = (F.col(f"_{names.index(x)}") for x in ("doc_id", "text", "source"))
    values = [x for i in range(len(names)) for x in (F.col(f"_{i}"), F.col(f"_{i}").isNull())]  # the hash skips nulls
    row = F.xxhash64(*values)
    rows, slots = _plan(work.select(doc_id.alias("doc_id"), text.alias("text"), source.alias("source"), row.alias("row")), weights, max_epochs, block_words, shard_slots, seed)
    parts = _pieces(rows, slots.groupBy("source", "block").agg(F.count("*").alias("times")), block_words).where("times is not null")
    parts = parts.groupBy("doc_id", "source", "ident", "row", "copy", "size").agg(F.array_sort(F.collect_list(F.struct("low", "words", "times"))).alias("parts"))
    # Rows equal in every column stay one row with a count until they meet their parts.
    work = work.where(F.length(F.trim(text)) > 0).groupBy(*work.columns).agg(F.count("*").alias("_n"))
    work = work.withColumn("_ident", F.xxhash64(doc_id, source, text)).withColumn("_row", row)
    work = work.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).alias("w")
    hit = (F.col("w._ident") == F.col("p.ident")) & (F.col("w._row") == F.col("p.row")) & (F.col("w._copy") == F.col("p.copy"))
    work = work.join(parts.alias("p"), hit & doc_id.eqNullSafe(F.col("p.doc_id")) & source.eqNullSafe(F.col("p.source"))).select("w.*", "p.parts", "p.size")
    work = work.withColumn("_time", F.explode(F.sequence(F.lit(1), F.array_max(F.transform("parts", lambda x: x["times"])).cast("int"))))
    work = work.withColumn("_mine", F.filter("parts", lambda x: x["times"] >= F.col("_time")))
    count = F.aggregate("_mine", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    # The words of a text are bound once, not found again for every part of it.
    words = F.array(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    some = F.transform(words, lambda w: F.array_join(F.flatten(F.transform("_mine", lambda x: F.slice(w, (x["low"] + 1).cast("int"), x["words"].cast("int")))), " "))[0]
    work = work.withColumn("_text", F.when(count == F.col("size"), text).otherwise(some))
    out = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return work.select(*(out.get(n, F.col(f"_{i}")).alias(n) for i, n in enumerate(names)))
