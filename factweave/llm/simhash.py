"""SimHash near-duplicates by anchor points of a covering code.

The anchors are the words of a product of two binary Golay codes over 46 of the
64 fingerprint bits. The Golay code is perfect: every 23 bits lie within 3 bits
of exactly one of its 4,096 words. So each fingerprint has one home anchor, and
a fingerprint within 2 bits of another lies within 3 + 2 bits of the other's home
(counted per block, with the excess of both blocks together at most 2). Every
distinct fingerprint is replicated to all such anchors (about 60 of 16.8 million)
and compared there with the fingerprints at home. Anchors at which nobody is at
home are dropped before anything is compared. The other 18 bits only take part in
the comparison.

Copies share a fingerprint, so only distinct fingerprints are replicated, and an
anchor returns a spanning set of links instead of all pairs.

Cases: null or blank text has fingerprint zero, which is linked like any other;
repeated rows give repeated rows; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factweave.llm import shingles
from factweave.llm.common import pick, stash
from factweave.llm.components import components

BLOCK, RADIUS, THRESHOLD = 23, 3, 2
#: Generator polynomial of the binary Golay code of length 23 (fixed value).
GOLAY = 0xAE3


def fingerprint(text: bytes | None, shingle_words: int = 3) -> int:
    """64-bit SimHash over word shingles, repeats included; each shingle is hashed by XXH64 with seed 42."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle_words:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        size = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(size + 1) - 1
        starts, ends = (ends - size)[: len(words) - shingle_words + 1].tolist(), ends[shingle_words - 1 :].tolist()
        h = xxhash.xxh64_intdigest
        hashes = [h(line[i:j], 42) for i, j in zip(starts, ends)]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of some hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """``doc_id, fp`` (fp: the fingerprint's bits as a signed long)."""

    def run(batches):
        for batch in batches:
            fps = [_signed(fingerprint(t.as_py(), shingle_words)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    rows = pick(docs, doc_id="doc_id", text="text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


@functools.cache
def _golay() -> tuple[np.ndarray, np.ndarray, list[list[np.ndarray]]]:
    """All code words; each syndrome's index; and for each syndrome the words' offsets by excess distance 0, 1 and 2."""
    words = np.zeros(1, np.int64)
    for i in range(12):
        words = np.concatenate([words, words ^ (GOLAY << i)])
    near: dict[int, list[np.ndarray]] = {}
    masks = [0] + [1 << i for i in range(23)] + [1 << i | 1 << j for i in range(23) for j in range(i)]
    masks += [1 << i | 1 << j | 1 << k for i in range(23) for j in range(i) for k in range(j)]
    weight_of = np.bitwise_count
    for leader in masks:  # every pattern of at most 3 bits leads exactly one coset
        d = weight_of(words ^ leader)
        near[syndrome(leader)] = [words[d <= RADIUS] ^ leader, words[d == RADIUS + 1] ^ leader, words[d == RADIUS + 2] ^ leader]
    return words, np.array(masks), [near[s] for s in range(1 << 11)]


def syndrome(x: int) -> int:
    """Remainder of the 23 bits by the generator polynomial."""
    for i in range(22, 10, -1):
        if x >> i & 1:
            x ^= GOLAY << (i - 11)
    return x


@functools.cache
def _syndromes() -> np.ndarray:
    """Syndromes of all values of 23 bits; they are linear, so the table doubles bit by bit."""
    out = np.zeros(1, np.int16)
    for i in range(23):
        out = np.concatenate([out, out ^ np.int16(syndrome(1 << i))])
    return out


def anchors(fp: int) -> tuple[int, np.ndarray]:
    """The home anchor of a fingerprint, and all anchors to which it is replicated (home included)."""
    near, table = _golay()[2], _syndromes()
    low, high = fp & 0x7FFFFF, fp >> BLOCK & 0x7FFFFF
    a, b = near[table[low]], near[table[high]]
    a, b = [x ^ low for x in a], [(x ^ high) << BLOCK for x in b]
    parts = [np.add.outer(np.concatenate(a[: 3 - e]), b[e]).ravel() for e in range(3)]
    return int(a[0][0] + b[0][0]), np.concatenate(parts)


def linked(values: np.ndarray) -> np.ndarray:
    """For distinct 64-bit values: the index of the smallest index reachable over links of at most 2 bits.

    Two values are within 2 bits exactly if they share a value within 1 bit of
    both, so sorting the 65 values around each finds all links without comparing
    all pairs, whatever the size of the group.
    """
    n = len(values)
    label = np.arange(n)
    if n <= 256:
        close = np.bitwise_count(values[:, None] ^ values[None, :]) <= THRESHOLD
        while True:
            new = np.where(close, label[None, :], n).min(axis=1)
            if (new == label).all():
                return label
            label = new
    around = np.concatenate([values, *(values ^ np.uint64(1 << i) for i in range(64))])
    order = np.argsort(around, kind="stable")
    ranked = around[order]
    key = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]]))
    member = order % n
    while True:
        least = np.minimum.reduceat(label[member], np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])))
        new = label.copy()
        np.minimum.at(new, member, least[key])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _replicas(batches):
    for batch in batches:
        fps = batch.column(0).to_numpy()
        homes, all_anchors, counts = [], [], []
        for fp in fps.view(np.uint64).tolist():
            home, mine = anchors(fp)
            homes.append(home)
            all_anchors.append(mine)
            counts.append(len(mine))
        if homes:
            where = np.concatenate(all_anchors)
            out = [pa.array(where), pa.array(np.repeat(fps, counts)), pa.array(where == np.repeat(homes, counts))]
            for at in range(0, len(where), 100_000):
                yield pa.RecordBatch.from_arrays([x.slice(at, 100_000) for x in out], ["anchor", "fp", "home"])


def _compare(batches):
    """Spanning links within each anchor's run of rows; rows come sorted by anchor."""

    def links(fps):
        values = np.sort(np.unique(fps).view(np.uint64))
        label = linked(values)
        rest = np.flatnonzero(label != np.arange(len(values)))
        return values[rest].view(np.int64), values[label[rest]].view(np.int64)

    def out(found):
        a, b = (np.concatenate([x[k] for x in found] or [np.zeros(0, np.int64)]) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    open_, run = None, []  # the last run may go on in the next batch
    for batch in batches:
        anchor, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(anchor):
            continue
        cut = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        found = []
        for i, j in zip(cut.tolist(), np.append(cut[1:], len(anchor)).tolist()):
            if anchor[i] != open_ and run:
                found.append(links(np.concatenate(run)))
                run = []
            open_ = anchor[i]
            run.append(fp[i:j])
        yield out(found)
    if run:
        yield out([links(np.concatenate(run))])


#: An anchor with more fingerprints is no single task; its fingerprints are linked by the values within one bit of them.
HOT_ANCHOR = 1 << 17


def _linked_by_values(fps: DataFrame) -> DataFrame:
    """``a, b``: links among distinct ``fp`` of at most 2 bits: two values are so close exactly if a value is within one bit of both."""
    around = F.concat(F.array("fp"), *(F.array(F.col("fp").bitwiseXOR(F.lit(_signed(1 << i)))) for i in range(64)))
    near = fps.select("fp", F.explode(around).alias("value"))
    least = near.groupBy("value").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return near.join(least, "value").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """``a, b``: links that connect just what links of at most 2 bits connect, among distinct ``fp``."""
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Each fingerprint becomes about 60 rows, so a few of them are a task's work.
    replicas = stash(distinct.select("fp").repartition(parts).mapInArrow(_replicas, "anchor long, fp long, home boolean"), "anchors")
    # An anchor where nobody is at home, or with a single fingerprint, compares nothing.
    shared = replicas.groupBy("anchor").agg(F.count("*").alias("n"), F.max("home").alias("home")).where("n > 1 and home").select("anchor", "n")
    met = replicas.select("anchor", "fp").join(shared, "anchor")
    found = met.where(F.col("n") <= HOT_ANCHOR).drop("n").repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(_compare, "a long, b long")
    return found.unionByName(_linked_by_values(met.where(F.col("n") > HOT_ANCHOR).select("fp").distinct())).distinct()


def near_duplicates(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """``doc_id, fp, component_id`` for every row; component_id is the smallest doc_id reachable."""
    fps = stash(fingerprints(docs, shingle_words), "fps")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(fingerprint_links(distinct)).select(F.col("node").alias("fp"), "root")
    named = distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stash(named.join(least, "root").select("fp", "component_id"), "named")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def _text_pairs(texts: DataFrame) -> DataFrame:
    """``a, b``: pairs of distinct texts ``node, simhash`` that connect those whose fingerprints differ in at most 2 bits."""
    least = stash(texts.groupBy("simhash").agg(F.min("node").alias("least")), "fps")
    copies = texts.join(least, "simhash").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    links = fingerprint_links(least.select(F.col("simhash").alias("fp")))
    ends = [least.select(F.col("simhash").alias(k), F.col("least").alias(f"node_{k}")) for k in "ab"]
    return copies.unionByName(links.join(ends[0], "a").join(ends[1], "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))


def one_of_each(docs: DataFrame, shingle_words: int = 3, similarity: float | None = None) -> DataFrame:
    """One row for each near-duplicate component of ``docs``, whatever the ids: that of the smallest doc_id, nulls last, then of the smallest row hash.

    Links are those of at most 2 bits, or, where ``similarity`` is given, of at least that Jaccard similarity of the sets of shingles:
    the pairs that fingerprints link are checked exactly, and so are those that ``shingles`` finds beyond the reach of 2 bits.
    """
    names = docs.columns
    work = docs.toDF(*(f"_{i}" for i in range(len(names))))
    values = [x for i in range(len(names)) for x in (F.col(f"_{i}"), F.col(f"_{i}").isNull())]  # the hash skips nulls
    work = work.withColumn("row", F.xxhash64(*values))
    doc_id, text = (F.col(f"_{names.index(n)}") for n in ("doc_id", "text"))
    keys = work.select(F.struct(doc_id.isNull().alias("none"), doc_id.alias("doc_id"), "row").alias("place"), text.cast("binary").alias("text"))
    if similarity is None:
        nodes = stash(_placed(keys, shingle_words), "fps").groupBy("fp").agg(F.min("place").alias("place"))
        links = fingerprint_links(nodes)
    else:
        nodes, links = shingles.similar(keys, shingle_words, similarity, lambda hashes: _signed(majority(hashes)), _text_pairs)
    roots = components(links).select(F.col("node").alias("fp"), "root")
    first = nodes.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp")).agg(F.min("place").alias("place"))
    kept = work.join(first.select(F.col("place.doc_id").alias("kept_id"), F.col("place.row").alias("kept_row")), doc_id.eqNullSafe(F.col("kept_id")) & (F.col("row") == F.col("kept_row")), "left_semi")
    # Rows that repeat in every column share their place.
    kept = kept.withColumn("copy", F.row_number().over(Window.partitionBy(doc_id, "row").orderBy("row"))).where("copy = 1")
    return kept.drop("row", "copy").toDF(*names)


def _placed(keys: DataFrame, shingle_words: int) -> DataFrame:
    """``place, fp`` for every row of ``keys`` (``place, text``)."""

    def run(batches):
        for batch in batches:
            fps = [_signed(fingerprint(t.as_py(), shingle_words)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["place", "fp"])

    return keys.mapInArrow(run, f"place {keys.schema['place'].dataType.simpleString()}, fp long")
