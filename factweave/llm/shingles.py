"""Links between texts whose sets of word shingles are similar, by SimHash, MinHash bands and an exact check.

The caller's fingerprints propose pairs first; those of at most 2 of 64 bits reach
few pairs of similarity 0.8, which differ in about 10, so bands propose the rest.
A text's node is the hash of its words. ``BANDS`` bands of ``ROWS`` minima each
propose pairs: two texts of similarity 0.8 share a band with probability
1 - (1 - 0.8^5)^20 = 0.9996. Proposed pairs are compared by their exact Jaccard
similarity, but not all of them. Each text is first compared with the text of its
band that shares most bands with others, as the origin of copies does, and with
the next in that order. Then come the pairs of a band that are not yet in one
component. In a band of at most ``LARGE`` texts all of them do, without those of
which fewer than ``ALIKE`` of 448 bits, one of each of as many minima, agree (of
texts of similarity 0.8 on average 403 do, with a deviation of 6.4). In a larger
one, texts are described by the shingles in which they differ from one text of the
band, the pivot. Two texts that are similar, of which one is not similar to the
pivot, have many of these differences in common, so they share one of their rarest;
only such pairs are compared, first those of neighbours among the texts with the
same difference, then all that are left. No similar pair is lost by this, and
copies that were edited independently hardly share rare differences, so their
comparisons grow with their number and not with its square. A band of many texts is
dealt to parts of at most about ``PART`` texts, which meet in blocks if it is a
small one.

Cases: null and blank texts share node 0 and no band; a text shorter than a
shingle is one shingle; empty tables give no links.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factweave.llm.common import stash
from factweave.llm.components import components

BANDS, ROWS = 20, 5
MINIMA, ALIKE, PART = 448, 382, 4096
#: A band of more texts compares no longer all of its pairs. What rounding may change in weights.
LARGE, SLACK = 64, 1e-6
#: Factors (odd) and summands of the minima's hash functions, from a fixed seed.
_DRAWN = np.random.default_rng(20).integers(0, 1 << 63, (2, MINIMA, 1), dtype=np.uint64)
FACTORS, SUMMANDS = _DRAWN[0] << np.uint64(1) | np.uint64(1), _DRAWN[1]


def node(words: list[bytes]) -> int:
    """A text's node: 0 without words."""
    x = xxhash.xxh3_64_intdigest(b" ".join(words)) if words else 0
    return x - (1 << 64) if x >> 63 else x


def shingle_hashes(words: list[bytes], shingle_words: int) -> np.ndarray:
    """Hashes of the shingles of lower-case ``words``, repeats included."""
    h = xxhash.xxh64_intdigest
    return np.array([h(b" ".join(words[i : i + shingle_words]), 42) for i in range(max(1, len(words) - shingle_words + 1))], np.uint64)


def shingle_set(words: list[bytes], shingle_words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of lower-case ``words``."""
    return np.unique(shingle_hashes(words, shingle_words))


def bands(hashes: np.ndarray) -> tuple[list[int], list[int]]:
    """One signed hash for each band of minima; and a bit of each minimum, as seven numbers."""
    least = np.full(MINIMA, (1 << 64) - 1, np.uint64)
    for at in range(0, len(hashes), 512):
        least = np.minimum(least, (FACTORS * hashes[None, at : at + 512] + SUMMANDS).min(axis=1))
    rows = least[: BANDS * ROWS].reshape(BANDS, ROWS)
    found = [xxhash.xxh64_intdigest(rows[k].tobytes(), k) for k in range(BANDS)]
    bits = np.packbits((least >> np.uint64(16)).astype(np.uint8) & 1, bitorder="little").view("<i8")
    return np.array(found, np.uint64).view(np.int64).tolist(), bits.tolist()


def jaccard(a: bytes, b: bytes) -> float:
    """Of two sorted sets of distinct hashes."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def _checked(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (``a, b``) that are similar enough."""

    def run(batches):
        for batch in batches:
            a, b, x, y = (c.to_pylist() for c in batch.columns)
            keep = pa.array([jaccard(p, q) >= similarity for p, q in zip(x, y)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    left, right = (sets.select(F.col("node").alias(k), F.col("set").alias(f"set_{k}")) for k in ("a", "b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _ordered(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _ranked(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """For each of ``members`` (``pivot, node``) the hashes that one of both has and the other has not, if more members of the pivot differ in them.

    Two sets are similar enough if they differ in at most ``u (|x| + |y|)`` hashes, ``u = (1 - s) / (1 + s)``. They differ in those in which just
    one of them differs from the pivot, so it takes ``weight(x) + weight(y)`` over 2 common differences, ``weight(x) = |difference(x)| - u |x|``;
    ``edge`` is the greatest weight of a text that is similar enough to the pivot itself. ``rest`` counts a text's differences from this one on,
    the rarest first: two texts have no more in common than what is left of both at the first that they share.
    """
    u = (1 - similarity) / (1 + similarity)

    def run(batches):
        for batch in batches:
            pivots, members, x, y = batch.columns
            found, size, weights, edges = [], [], [], []
            for k in range(len(batch)):
                own, other = np.frombuffer(x[k].as_py(), np.uint64), np.frombuffer(y[k].as_py(), np.uint64)
                apart = np.setxor1d(own, other, assume_unique=True).view(np.int64)
                found.append(apart)
                size.append(len(apart))
                weights.append(len(apart) - u * len(own))
                edges.append(u * len(other))
            if found:
                at = np.repeat(np.arange(len(size)), size)
                out = [pa.array(np.array(c)[at]) for c in (pivots.to_numpy(), members.to_numpy(), weights, edges)] + [pa.array(np.concatenate(found))]
                for k in range(0, len(at), 100_000):
                    yield pa.RecordBatch.from_arrays([c.slice(k, 100_000) for c in out], ["pivot", "node", "weight", "edge", "element"])

    texts, of_pivots = sets.select("node", F.col("set").alias("x")), sets.select(F.col("node").alias("pivot"), F.col("set").alias("y"))
    # A pivot may have many members, and a member as many rows as differences; members are dealt evenly.
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = members.join(texts, "node").join(of_pivots, "pivot").select("pivot", "node", "x", "y").repartition(parts)
    apart = stash(both.mapInArrow(run, "pivot long, node long, weight double, edge double, element long"), "apart")
    common = apart.groupBy("pivot", "element").agg(F.count("*").alias("n")).where("n > 1")
    order = Window.partitionBy("pivot", "node").orderBy(F.col("n").desc(), F.col("element").desc())
    ranked = apart.join(common, ["pivot", "element"]).withColumn("rest", F.row_number().over(order)).drop("n")
    # What a text must have in common at least with any other: one of a lower weight may be the pivot, and of two that are not linked yet one is beyond the edge.
    return ranked.where(F.col("rest") >= (F.col("weight") - F.col("edge")) / 2 - SLACK).withColumn("short", F.col("rest") >= (F.col("weight") + F.greatest("weight", "edge")) / 2 - SLACK)


def _enough(one: dict, other: dict):
    """Whether two texts may have as much in common as it takes."""
    return F.least(one["rest"], other["rest"]) >= (one["weight"] + other["weight"]) / 2 - SLACK


def _rooted(ranked: DataFrame, roots: DataFrame) -> DataFrame:
    return ranked.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _chained(ranked: DataFrame, roots: DataFrame) -> DataFrame:
    """``a, b``: of the texts with a difference in common, each with the next one, so that large groups become one component by few pairs."""
    order = Window.partitionBy("pivot", "element").orderBy("weight", "node")
    fields = ["node", "weight", "rest", "root"]
    pairs = _rooted(ranked, roots).withColumn("next", F.lead(F.struct(*fields)).over(order)).where("next is not null and short")
    pairs = pairs.where((F.col("root") != F.col("next.root")) & _enough({k: F.col(k) for k in fields}, {k: F.col(f"next.{k}") for k in fields}))
    return pairs.select(*_ordered(F.col("node"), F.col("next.node"))).distinct()


def _allowed(ranked: DataFrame, roots: DataFrame) -> DataFrame:
    """``a, b``: all pairs of different components that may have enough in common."""
    rooted = _rooted(ranked, roots)
    fields = ["node", "weight", "rest", "root"]
    light, heavy = (rooted.select("pivot", "element", "short", *(F.col(k).alias(f"{k}_{side}") for k in fields)) for side in "xy")
    x, y = ({k: F.col(f"{k}_{side}") for k in fields} for side in "xy")
    lighter = (x["weight"] < y["weight"]) | (x["weight"] == y["weight"]) & (x["node"] < y["node"])
    pairs = light.where("short").drop("short").join(heavy.drop("short"), ["pivot", "element"]).where(lighter & (x["root"] != y["root"]) & _enough(x, y))
    return pairs.select(*_ordered(x["node"], y["node"])).distinct()


def similar(keys: DataFrame, shingle_words: int, similarity: float, fingerprint: Callable, text_pairs: Callable) -> tuple[DataFrame, DataFrame]:
    """``fp, place`` (the least) of every distinct text of ``keys`` (``place, text``), and links ``a, b`` that connect what all links connect.

    ``fingerprint`` makes a long of a text's shingle hashes, and ``text_pairs`` proposes pairs ``a, b`` of the texts ``node, simhash``.
    """

    def run(batches):
        for batch in batches:
            nodes, found, fps = [], [], []
            for text in batch.column(1):
                words = (text.as_py() or b"").lower().split()
                nodes.append(node(words))
                hashes = shingle_hashes(words, shingle_words) if words else None
                found.append(bands(np.unique(hashes)) if words else ([], []))
                fps.append(fingerprint(hashes) if words else None)
            columns = [pa.array(nodes, pa.int64()), *(pa.array([x[k] for x in found], pa.list_(pa.int64())) for k in (0, 1)), pa.array(fps, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["place", "fp", "bands", "bits", "simhash"])

    def sets_of(batches):
        for batch in batches:
            found = [shingle_set(text.as_py().lower().split(), shingle_words).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["node", "set"])

    place = keys.schema["place"].dataType.simpleString()
    rows = stash(keys.mapInArrow(run, f"place {place}, fp long, bands array<long>, bits array<long>, simhash long"), "minima")
    nodes = stash(rows.groupBy("fp").agg(F.min("place").alias("place"), F.first("bands").alias("bands"), F.first("bits").alias("bits"), F.first("simhash").alias("simhash")), "nodes")
    paired = stash(text_pairs(nodes.where("simhash is not null").select(F.col("fp").alias("node"), "simhash")).select(*_ordered("a", "b")), "paired")
    banded = nodes.select(F.col("fp").alias("node"), F.explode("bands").alias("band"))
    counts = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / PART).cast("int")
    shared = banded.join(counts, "band").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node", "band"), F.col("parts")).cast("int"))
    shared = stash(shared, "shared")
    # How many texts a text meets, all bands together: the origin of many copies meets most.
    popular = shared.groupBy("node").agg(F.sum("n").alias("met"))
    ranked = shared.select("node", "band", "n", "part", "parts").join(popular, "node")
    order = Window.partitionBy("band", "part").orderBy(F.col("met").desc(), "node")
    after = ranked.withColumn("next", F.lead("node", 1).over(order)).withColumn("first", F.first("node").over(order)).withColumn("place", F.row_number().over(order))
    heads = Window.partitionBy("band").orderBy(F.col("met").desc(), "node")
    first = after.where("place = 1 and parts > 1").withColumn("next", F.lead("node", 1).over(heads)).withColumn("first", F.first("node").over(heads))
    met = after.unionByName(first).select("node", F.explode(F.array("next", "first")).alias("other")).where("other is not null and other <> node")
    # All texts of a large band meet one of it, its pivot.
    large = ranked.where(F.col("n") > LARGE)
    pivots = stash(large.groupBy("band").agg(F.min_by("node", F.struct(-F.col("met"), "node")).alias("pivot")), "pivots")
    met = met.unionByName(large.join(pivots, "band").where("node <> pivot").select("node", F.col("pivot").alias("other")))
    near = stash(met.select(*_ordered("node", "other")).unionByName(paired).distinct(), "near")
    # Texts of the nodes that meet others, each once.
    wanted = shared.select("node").unionByName(paired.select(F.explode(F.array("a", "b")).alias("node"))).distinct().join(nodes.select(F.col("fp").alias("node"), "place"), "node")
    texts = keys.join(wanted, (F.col("text").isNotNull()) & keys["place"].eqNullSafe(wanted["place"]), "inner").select("node", "text")
    sets = stash(texts.mapInArrow(sets_of, "node long, set binary").dropDuplicates(["node"]), "sets")
    links = stash(_checked(near, sets, similarity), "links")
    # The pairs of a band that are in different components so far: of small bands all of them, of large ones those that their differences allow.
    roots = components(links)
    named = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = named.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("band")
    named = stash(named.join(split, "band").join(nodes.select(F.col("fp").alias("node"), "bits", "bands"), "node"), "split")
    members = named.where(F.col("n") > LARGE).join(pivots, "band").select("pivot", "node").distinct()
    ranked = stash(_ranked(members, sets, similarity), "ranked")
    chained = stash(_checked(_chained(ranked, roots).join(near, ["a", "b"], "left_anti"), sets, similarity), "links")
    links = links.unionByName(chained)
    few = named.where(F.col("n") <= LARGE)
    other = few.select("band", F.col("node").alias("other"), F.col("root").alias("other_root"), F.col("bits").alias("other_bits"), F.col("bands").alias("other_bands"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    alike = F.lit(MINIMA) - sum(F.bit_count(F.col("bits")[k].bitwiseXOR(F.col("other_bits")[k])) for k in range(MINIMA // 64))
    # A pair that shares several bands is proposed by the least of them.
    once = F.array_min(F.array_intersect("bands", "other_bands")) == F.col("band")
    rest = few.join(other, ["band", "part"]).where((F.col("node") < F.col("other")) & (F.col("root") != F.col("other_root")) & (alike >= ALIKE) & once)
    rest = rest.select(F.col("node").alias("a"), F.col("other").alias("b")).unionByName(_allowed(ranked, components(links))).distinct().join(near, ["a", "b"], "left_anti")
    return nodes.select("fp", "place"), links.unionByName(stash(_checked(rest, sets, similarity), "links"))
