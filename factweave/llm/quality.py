"""Quality rules: base rules, and an isolation forest on rule statistics.

Each rule measures a text (symbols a word, shares of repeated words, of words in
capitals, ...). Shares of few words are drawn towards what prose has, and
measures are roots, so that small differences near zero count. The forest
isolates documents by random splits of all measures together; the fewer splits it
takes, the more anomalous the document. No rule has a range of its own.

All documents without a label train the forest: they are dealt over its trees by
hash, each to one tree, or, where that leaves a tree fewer than ``tree_rows``, to as
many as it takes. All labelled ones, which it has not seen, calibrate its threshold.
That is the score at which the share of bad rows above it, less ``good_cost`` times
the share of good rows above it, is largest. The driver holds trees of bounded depth
and the labelled rows' numbers in ``BINS`` ranges of scores, whatever their number.

Cases: null or blank text has no words and fails the base rule; without labelled
rows of good quality, or documents without a label, the forest rejects nothing,
without bad ones only what is farther from the good rows' middle than any of them
by half; a document labelled good and bad neither trains nor calibrates, nor does
one without id, but they are judged; repeated rows give repeated rows,
but train and calibrate once; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factweave.llm.common import pick, stash

LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What prose has of each measure: the value that a text of few words is drawn to, as if by so many words more.
PROSE = {"symbols": 0.0, "repeated": 0.0, "mean_word": 5.0, "upper": 0.0, "odd_ends": 0.0, "bare": 0.0, "top_word": 0.05, "distinct": 0.75, "stops": 0.14}
PRIOR_WORDS = 50
SYMBOLS = "#*$%&|<>"
_ODD_ENDS = b"!" + SYMBOLS.encode()
_STOPS = b".,;:?"
_SYMBOL_BYTES = [s.encode() for s in SYMBOLS]


def statistics(text: bytes | None) -> tuple:
    """The base statistics of a whole text, then its measures in the order of ``PROSE``."""
    raw = text or b""
    words = raw.split()
    n = len(words)
    symbols = sum(map(raw.count, _SYMBOL_BYTES))
    if not n:
        return (0, 0, symbols, 0, 0, *[0.0] * len(PROSE))
    chars = len(b"".join(words).decode())
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    dup_lines = len(lines) - len(set(lines))
    repeated = 0
    if n >= 5:
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
        if len(set(windows)) < len(windows):
            counts = Counter(windows)
            upto = 0  # words before this are counted or in no repeated window
            for at, window in enumerate(windows):
                if counts[window] > 1:
                    repeated += at + 5 - max(at, upto)
                    upto = at + 5
    per_word = Counter(words)
    upper = sum(1 for w in words if w.isupper() or (w[0] > 127 and w.decode().isupper()))
    ends = Counter(w[-1] for w in words)
    odd, stops = sum(ends[c] for c in _ODD_ENDS), sum(ends[c] for c in _STOPS)
    bare = sum(1 for w in words if len(w) == 1 and not w.isalnum())
    # Texts have n^0.87 different words or so, whatever their length.
    totals = (symbols, repeated, chars, upper, odd, bare, per_word.most_common(1)[0][1], len(per_word) * n**0.13 / 2, stops)
    measures = (math.sqrt((t + PRIOR_WORDS * p) / (n + PRIOR_WORDS)) for t, p in zip(totals, PROSE.values()))
    return (n, chars, symbols, dup_lines, repeated, *measures)


def _mean_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


class IsolationForest:
    """Random trees as flat arrays; ``score`` is near 1 for rows that few splits isolate."""

    def __init__(self, rows: np.ndarray, trees: int = 100, tree_rows: int = 256, seed: int = 42):
        pick_of = random.Random(seed)
        self.size = min(tree_rows, len(rows))
        self.trees = []
        for _ in range(trees):
            mine = rows[pick_of.sample(range(len(rows)), self.size)]
            self.trees.append(self._grow(mine, pick_of, math.ceil(math.log2(max(2, self.size)))))

    @classmethod
    def of(cls, trees: list[tuple], size: int) -> IsolationForest:
        """A forest of grown trees of ``size`` rows each on average."""
        made = cls.__new__(cls)
        made.trees, made.size = trees, size
        return made

    @staticmethod
    def _grow(rows, pick_of, depth_limit):
        feature, cut, left, right, path = [], [], [], [], []

        def grow(part, depth):
            at = len(feature)
            for x in (feature, cut, left, right, path):
                x.append(0)
            low, high = part.min(axis=0), part.max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth >= depth_limit or len(part) <= 1 or not len(usable):
                left[at] = right[at] = at
                path[at] = depth + _mean_path(len(part))
                return at
            f = int(usable[pick_of.randrange(len(usable))])
            c = low[f] + (1 - pick_of.random()) * (high[f] - low[f])
            c = c if c > low[f] else high[f]
            feature[at], cut[at] = f, c
            below = part[:, f] < c
            left[at] = grow(part[below], depth + 1)
            right[at] = grow(part[~below], depth + 1)
            return at

        grow(rows, 0)
        return np.array(feature), np.array(cut, float), np.array(left), np.array(right), np.array(path, float), depth_limit

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        line = np.arange(len(rows))
        for feature, cut, left, right, path, depth in self.trees:
            at = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                at = np.where(rows[line, feature[at]] < cut[at], left[at], right[at])
            total += path[at]
        return 2.0 ** (-total / len(self.trees) / max(_mean_path(self.size), 1e-9))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 10 or 100 * n_repeat_words > 20 * n_words


class Model:
    """A trained forest and its threshold; without a forest everything that passes the base rules is kept."""

    def __init__(self, forest: IsolationForest | None = None, threshold: float = 1.0):
        self.forest, self.threshold = forest, threshold

    def judge(self, texts: list[bytes | None]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        """Statistics, base failures, anomaly scores and verdicts of some texts."""
        rows = [statistics(t) for t in texts]
        failed = np.array([base_failed(r[0], r[4]) for r in rows], bool)
        values = np.array([r[len(LONGS) :] for r in rows], float).reshape(-1, len(PROSE))
        anomaly = self.forest.score(values) if self.forest and len(rows) else np.zeros(len(rows))
        return rows, failed, anomaly, ~failed & (anomaly <= self.threshold)


def calibrated(good: np.ndarray, bad: np.ndarray, good_cost: float) -> float:
    """The threshold for the scores of labelled rows, midway between two of them; scores above it are rejected."""
    if not len(bad):
        return float(good.max() + (good.max() - np.median(good)) / 2)
    cuts = np.unique(np.concatenate([good, bad]))
    lost, caught = (1 - np.searchsorted(np.sort(x), cuts, side="right") / max(1, len(x)) for x in (good, bad))
    gain = caught - good_cost * lost
    at = np.flatnonzero(gain == gain.max())[-1]
    return float((cuts[at] + cuts[min(at + 1, len(cuts) - 1)]) / 2)


#: Ranges of scores, which lie between 0 and 1.
BINS = 4096


def threshold(scores: DataFrame, good_cost: float) -> float | None:
    """What ``calibrated`` finds for the labelled rows ``score, quality``, however many; None without good ones."""
    good, bad = (F.count(F.when(F.col("quality") == q, 1)) for q in (1, 0))
    by = stash(scores.groupBy("score").agg(good.alias("good"), bad.alias("bad")).withColumn("bin", F.floor(F.col("score") * BINS)), "scores")
    bins = sorted(map(tuple, by.groupBy("bin").agg(F.sum("good"), F.sum("bad")).collect()))
    goods, bads = (sum(x[k] for x in bins) for k in (1, 2))
    if not goods:
        return None
    if not bads:
        middle, most = scores.agg(F.median("score"), F.max("score")).first()
        return most + (most - middle) / 2
    below = [(x[0], sum(y[1] for y in bins[:n]), sum(y[2] for y in bins[:n])) for n, x in enumerate(bins)]
    upto = by.join(F.broadcast(by.sparkSession.createDataFrame(below, "bin long, good_below long, bad_below long")), "bin")
    order = Window.partitionBy("bin").orderBy("score")
    caught, lost = (1 - (F.col(f"{k}_below") + F.sum(k).over(order)) / n for k, n in (("bad", bads), ("good", goods)))
    best = upto.select("score", (caught - good_cost * lost).alias("gain")).orderBy(F.col("gain").desc(), F.col("score").desc()).first()["score"]
    after = by.where(F.col("score") > best).agg(F.min("score")).first()[0]
    return (best + (best if after is None else after)) / 2


def grown(sample: DataFrame, trees: int, tree_rows: int, seed: int) -> IsolationForest | None:
    """A forest that every row of ``sample`` (``doc_id, v``) trains; None without rows."""
    rows = sample.count()
    if not rows:
        return None
    each = min(trees, math.ceil(trees * tree_rows / rows))  # trees of a row
    strides = [x for x in range(1, trees + 1) if math.gcd(x, trees) == 1]
    start = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(trees))
    stride = F.get(F.array(*map(F.lit, strides)), F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(len(strides))).cast("int"))
    dealt = sample.select("v", F.explode(F.transform(F.sequence(F.lit(0), F.lit(each - 1)), lambda k: F.pmod(start + k * stride, F.lit(trees)).cast("int"))).alias("tree"))
    depth = math.ceil(math.log2(max(2, min(tree_rows, rows))))

    def grow(group: pa.Table) -> pa.Table:
        v = group["v"].combine_chunks().flatten().to_numpy().reshape(len(group), -1)
        number = group["tree"][0].as_py()
        parts = IsolationForest._grow(v, random.Random(f"{seed} {number}"), depth)[:5]
        kinds = (pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64())
        return pa.table([pa.array([number], pa.int32()), *(pa.array([x.tolist()], pa.list_(k)) for x, k in zip(parts, kinds))], ["tree", "feature", "cut", "left", "right", "path"])

    found = dealt.groupBy("tree").applyInArrow(grow, "tree int, feature array<int>, cut array<double>, left array<int>, right array<int>, path array<double>").collect()
    made = [(*(np.array(r[k]) for k in ("feature", "cut", "left", "right", "path")), depth) for r in sorted(found, key=lambda r: r["tree"])]
    return IsolationForest.of(made, round(rows * each / trees))


def fit(docs: DataFrame, labels: DataFrame, trees: int = 200, tree_rows: int = 256, good_cost: float = 50.0, seed: int = 42) -> Model:
    """Train the forest on all of ``docs`` without a label and calibrate its threshold on all labelled rows.

    ``labels`` has ``doc_id, quality`` (1 good, 0 bad).
    """
    rows = pick(docs, doc_id="doc_id", text="text").where("doc_id is not null")
    known = pick(labels, doc_id="doc_id", quality="quality").where("quality in (0, 1) and doc_id is not null")
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"), F.max("quality").alias("most"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            stats = [statistics(t.as_py()) for t in batch.column(1)]
            passed = pa.array([not base_failed(r[0], r[4]) for r in stats], pa.bool_())
            values = pa.array([r[len(LONGS) :] for r in stats], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["doc_id", "v"]).filter(passed)

    def score(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            v = np.array(batch.column(1).to_pylist(), float).reshape(-1, len(PROSE))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(forest.score(v))], ["quality", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, v array<double>")
    found = stash(found.groupBy("doc_id").agg(F.min("v").alias("v")).join(known, "doc_id", "left").where("most is null or quality = most").select("doc_id", "quality", "v"), "measures")
    forest = grown(found.where("quality is null").select("doc_id", "v"), trees, tree_rows, seed)
    if not forest:
        return Model()
    limit = threshold(found.where("quality is not null").select("quality", "v").mapInArrow(score, "quality int, score double"), good_cost)
    return Model() if limit is None else Model(forest, limit)


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, base statistics, ``base_failed``, ``anomaly`` and ``kept`` for every row of ``docs``, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows, failed, anomaly, kept = model.judge([t.as_py() for t in batch.column(1)])
            longs = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(LONGS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *longs, pa.array(failed), pa.array(anomaly), pa.array(kept)], ["doc_id", *LONGS, "base_failed", "anomaly", "kept"])

    rows = pick(docs, doc_id="doc_id", text="text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in LONGS) + ", base_failed boolean, anomaly double, kept boolean")


def kept_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = [t.as_py() for t in batch.column(batch.schema.get_field_index("_text")).cast(pa.binary())]
            yield batch.filter(pa.array(model.judge(texts)[3]))

    names = docs.columns
    work = docs.toDF(*(f"_{i}" for i in range(len(names)))).withColumnRenamed(f"_{names.index('text')}", "_text")
    return work.mapInArrow(run, work.schema).toDF(*names)
