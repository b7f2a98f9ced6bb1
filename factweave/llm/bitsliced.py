"""Exact top-k inner-product search over a bit-sliced index.

Vectors are quantised to integers and gathered in blocks. A block's index holds,
for every component, one bitmap over the block's rows for each of the upper bits
of the component (the lower ``STEP_BITS`` are left out). For a query, the slices
of all components are added, weighted by the query's own upper bits, with bitmap
arithmetic only: carry-save adders turn three bitmaps of one weight into two. The
sum's slices are then read from the most significant downward: they give the
k-th largest quantised score, and all rows that could still be among the k best
within the error bound of the quantisation (by Cauchy-Schwarz). These boundary
rows, and no others, are resolved by their exact integer inner products.

A block's index is built once, in the one task that has the block, and the
queries stream past it; so what is shuffled is every block once, and the queries
once for each block. A block returns the k best of its rows for each query (ties
to the smaller id), which are then merged.

Cases: vectors that are null, or hold null or non-finite components, take no
part; a query meets only rows of its own length; rows with the query's id are not
its candidates; repeated query rows are queries of their own; empty tables give
no rows; extra columns are ignored. Scores are exact while they fit a long.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factweave.llm.common import pick, stash

STEP_BITS = 4
ROWS, QUERIES = 16384, 128


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id`` (long)``, v``: components as floor(scale * x), of vectors without null or non-finite components."""
    rows = pick(vectors, vec_id=id_col, v=vector_col).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("v", lambda x: x.cast("double")).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(~bad).select("vec_id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))


def _packed(rows: DataFrame, blocks: int, size: int) -> DataFrame:
    """Rows ``number, block, dim, ids, data``: the ids and components, as packed longs, of at most ``size`` vectors of one length, by number."""

    def run(batches: Iterator[pa.RecordBatch]):
        block = TaskContext.get().partitionId()
        numbers = itertools.count(block << 32)
        ids: dict[int, list[bytes]] = {}
        data: dict[int, list[bytes]] = {}
        held: dict[int, int] = {}

        def out(dims: list[int]):
            columns = [pa.array([next(numbers) for _ in dims], pa.int64()), pa.array([block] * len(dims), pa.int32()), pa.array(dims, pa.int32()), pa.array([b"".join(ids[d]) for d in dims], pa.binary()), pa.array([b"".join(data[d]) for d in dims], pa.binary())]
            for d in dims:
                del ids[d], data[d], held[d]
            return pa.RecordBatch.from_arrays(columns, ["number", "block", "dim", "ids", "data"])

        for batch in batches:
            vectors = batch.column(1)
            lengths = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy()
            at = np.concatenate([[0], np.cumsum(lengths)])
            own = batch.column(0).to_numpy()
            for dim in np.unique(lengths).tolist():
                mine = np.flatnonzero(lengths == dim)
                for k in range(0, len(mine), size):
                    part = mine[k : k + size]
                    if held.get(dim, 0) + len(part) > size:
                        yield out([dim])
                    ids.setdefault(dim, []).append(own[part].tobytes())
                    data.setdefault(dim, []).append(flat[(at[part][:, None] + np.arange(dim)).ravel()].tobytes() if dim else b"")
                    held[dim] = held.get(dim, 0) + len(part)
        if ids:
            yield out(list(ids))

    return rows.repartition(blocks).mapInArrow(run, "number long, block int, dim int, ids binary, data binary")


class Adder:
    """Sum of weighted bitmaps, bit-sliced: pending bitmaps by weight, three of a weight become two by a full adder."""

    def __init__(self):
        self.pending: list[list[np.ndarray]] = []

    def add(self, bitmap: np.ndarray, weight: int) -> None:
        while True:
            while len(self.pending) <= weight:
                self.pending.append([])
            mine = self.pending[weight]
            if len(mine) < 2:
                mine.append(bitmap)
                return
            a, b = mine.pop(), mine.pop()
            half = a ^ b
            np.bitwise_and(a, b, out=a)
            np.bitwise_and(half, bitmap, out=b)
            np.bitwise_or(a, b, out=a)  # the carry
            np.bitwise_xor(half, bitmap, out=half)
            mine.append(half)
            bitmap, weight = a, weight + 1

    def slices(self, zero: np.ndarray) -> list[np.ndarray]:
        """One bitmap for each weight, the lowest first."""
        weight = 0
        while weight < len(self.pending):
            mine = self.pending[weight]
            if len(mine) == 2:
                a, b = mine
                self.pending[weight] = [a ^ b]
                self.add(a & b, weight + 1)
            weight += 1
        return [p[0] if p else zero for p in self.pending]


def kth_largest(slices: list[np.ndarray], rows: np.ndarray, k: int) -> np.ndarray:
    """For each query (first axis) the k-th largest sum among ``rows`` (bitmaps), from the highest slice down; the least if there are fewer."""
    sure, open_ = np.zeros_like(rows), rows.copy()
    value = np.zeros(len(rows), np.int64)
    for weight in range(len(slices) - 1, -1, -1):
        high = open_ & slices[weight]
        enough = np.bitwise_count(sure | high).sum(axis=1, dtype=np.int64) >= k
        value += enough.astype(np.int64) << weight
        mask = _mask(enough)
        sure |= high & ~mask
        open_ = (high & mask) | (open_ & ~slices[weight] & ~mask)
    return value


def at_least(slices: list[np.ndarray], rows: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Bitmaps of the rows whose sum is at least each query's value, from the highest slice down."""
    above, equal = np.zeros_like(rows), rows.copy()
    for weight in range(len(slices) - 1, -1, -1):
        one = _mask((value >> weight & 1).astype(bool))
        above |= equal & slices[weight] & ~one
        equal &= ~(slices[weight] ^ one)
    out = above | equal
    out[value <= 0] = rows[value <= 0]
    out[value >> len(slices) > 0] = 0
    return out


def _mask(flags: np.ndarray) -> np.ndarray:
    return (np.zeros(len(flags), np.uint64) - flags.astype(np.uint64))[:, None]


class Index:
    """The bit-sliced index of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        n, self.dim = vectors.shape
        self.words = -(-n // 64)
        self.least = self.vectors.min(axis=0)
        upper = (self.vectors - self.least) >> STEP_BITS
        self.bits = max(1, int(upper.max(initial=0)).bit_length())
        padded = np.zeros((self.words * 64, self.dim), np.int64)
        padded[:n] = upper
        planes = (padded.T[:, None, :] >> np.arange(self.bits)[None, :, None]) & 1
        self.slices = np.ascontiguousarray(np.packbits(planes.astype(np.uint8), axis=2, bitorder="little")).view("<u8")
        rows = np.zeros(self.words * 64, np.uint8)
        rows[:n] = 1
        self.rows = np.packbits(rows, bitorder="little").view("<u8")
        middle = self.least + ((1 << STEP_BITS) - 1) / 2
        coarse = (upper << STEP_BITS) + middle
        self.error = float(np.sqrt(((self.vectors - coarse) ** 2).sum(axis=1)).max())
        self.norm = float(np.sqrt((coarse**2).sum(axis=1)).max())

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query number, row number and exact score of each query's k best rows (ties to smaller ids)."""
        unit = 1 << STEP_BITS
        weight = (np.abs(queries) + unit // 2) >> STEP_BITS
        sign = queries < 0
        adder, q = Adder(), len(queries)
        for d in range(self.dim):
            negative = _mask(sign[:, d])
            mine = weight[:, d]
            for j in range(int(mine.max(initial=0)).bit_length()):
                has = _mask((mine >> j & 1).astype(bool))
                if has.any():
                    for i in range(self.bits):
                        # A negative weight adds the complement, which shifts the query's sums by a constant.
                        adder.add((self.slices[d, i][None, :] ^ negative) & has, i + j)
        slices = adder.slices(np.zeros((q, self.words), np.uint64))
        rows = np.repeat(self.rows[None, :], q, axis=0)
        first, last = np.searchsorted(self.ids, query_ids), np.searchsorted(self.ids, query_ids, side="right")
        for at in np.flatnonzero(last > first):
            for r in range(first[at], last[at]):
                rows[at, r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
        rest = queries - np.where(sign, -weight, weight) * unit
        bound = np.sqrt((queries.astype(float) ** 2).sum(axis=1)) * self.error + np.sqrt((rest.astype(float) ** 2).sum(axis=1)) * self.norm
        cut = kth_largest(slices, rows, k) - np.ceil(2 * bound / unit**2).astype(np.int64) - 1
        near = np.unpackbits(at_least(slices, rows, cut).view(np.uint8), axis=1, bitorder="little")
        who, row = np.nonzero(near)
        score = np.empty(len(who), np.int64)
        for at in range(0, len(who), 1 << 16):
            part = slice(at, at + (1 << 16))
            score[part] = (queries[who[part]] * self.vectors[row[part]]).sum(axis=1)
        order = np.lexsort((row, -score, who))
        who, row, score = who[order], row[order], score[order]
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        keep = rank < k
        return who[keep], row[keep], score[keep]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: each row of ``queries`` against all rows of ``vectors``."""
    rows = stash(quantised(vectors, id_col, vector_col, scale), "vectors")
    asked = stash(quantised(queries, id_col, vector_col, scale), "queries")
    blocks = max(1, -(-rows.count() // ROWS))
    have = _packed(rows, blocks, 2 * ROWS).withColumn("asks", F.lit(False))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    want = _packed(asked, max(1, -(-asked.count() // QUERIES)), QUERIES).withColumn("block", every).withColumn("asks", F.lit(True))
    both = have.unionByName(want).repartitionById(blocks, F.col("block")).sortWithinPartitions("dim", "asks")

    def run(batches: Iterator[pa.RecordBatch]):
        names = ["number", "row", "query_id", "vec_id", "score"]
        dim, indexes = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                if r["dim"] != dim:
                    dim, indexes = r["dim"], []
                ids = np.frombuffer(r["ids"], np.int64)
                data = np.frombuffer(r["data"], np.int64).reshape(len(ids), dim)
                if not r["asks"]:
                    indexes.append(Index(ids, data))
                for index in indexes if r["asks"] else ():
                    who, row, score = index.best(ids, data, k)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(who), r["number"]), who, ids[who], index.ids[row], score)], names)

    found = both.mapInArrow(run, "number long, row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("number", "row").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best))
    return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
