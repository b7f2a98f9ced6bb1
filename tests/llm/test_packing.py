import zlib

import numpy as np
from tokenizers import Tokenizer

from factweave.llm import packing

DOCS = "doc_id long, text string, piece string, Length string"


def test_pieces_and_places(spark):
    texts = [None, "", "one", "Füße don't <|endoftext|> x　y\x1cz", "word " * 5000, "long run " * 9000, "tie", "tie"]
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts)] + [(None, "no id", "x", "x"), (2, "one", "x", "x")]
    docs = spark.createDataFrame(rows, DOCS)
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    want = []
    for i, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want.append((i, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = packing.pack(docs).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got if r["doc_id"] is not None) == sorted(w for w in want if w[0] is not None)
    assert len(got) == len(want)
    used = {}
    for r in got:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack(docs.where("doc_id < 0")).count() == 0


def test_best_fit_in_bounded_space():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 2000, 20000).tolist()
    packer = packing.Packer(4096, 256)
    free = {}
    for n in sizes:
        before = {b: f for b, f in free.items() if f >= n}
        number, offset = packer.put(n)
        if number in free:
            assert free[number] == min(before.values())  # the fullest that still holds it
            assert offset == 4096 - free[number]
        assert packer.count <= 256
        free[number] = free.get(number, 4096) - n
        open_ = {b for bins in packer.by_free for b in bins}
        free = {b: f for b, f in free.items() if b in open_}
    assert packer.opened <= 1.02 * -(-sum(sizes) // 4096)


class Plain:
    """Best-fit by looking at every open sequence: (free, since, number)."""

    def __init__(self, sequence, open_bins):
        self.sequence, self.open_bins, self.open, self.opened, self.closed, self.time = sequence, open_bins, [], 0, 0, 0

    def put(self, length):
        self.time += 1
        fits = [b for b in self.open if b[0] >= length]
        if fits:
            best = min(fits, key=lambda b: (b[0], -b[1]))
            self.open.remove(best)
        else:
            best = (self.sequence, 0, self.opened)
            self.opened += 1
        if best[0] > length:
            self.open.append((best[0] - length, self.time, best[2]))
        if len(self.open) > self.open_bins:
            self.open.remove(min(self.open))
            self.closed += 1
        return best[2], self.sequence - best[0]


def test_query_packs_online_and_closes_the_fullest(spark):
    r = np.random.default_rng(8)
    docs = spark.createDataFrame([(i, "word " * int(n)) for i, n in enumerate(r.integers(1, 900, 700))], "doc_id long, text string")
    cut = packing.pieces(docs, sequence=1024)
    for open_bins in (1, 3, 20):
        plain = Plain(1024, open_bins)
        want = {(p["doc_id"], p["piece"]): plain.put(p["length"]) for p in packing.dealt(cut, 1).collect()}
        got = packing.pack(docs, sequence=1024, open_bins=open_bins).collect()
        assert {(g["doc_id"], g["piece"]): (g["sequence_id"], g["offset"]) for g in got} == want
        assert plain.closed > 0  # the bound binds
    lengths = [p["length"] for p in packing.dealt(cut, 1).collect()]
    assert lengths != sorted(lengths, reverse=True)
    few, many = (len({g["sequence_id"] for g in packing.pack(docs, sequence=1024, open_bins=k).collect()}) for k in (1, 128))
    assert many < few


def test_packers_have_sequences_of_their_own(spark):
    docs = spark.range(500).selectExpr("id AS doc_id", "repeat('some words ', cast(id % 90 AS int)) AS text")
    got = packing.pack(docs, packer_tokens=9000).collect()
    assert len({g["sequence_id"] >> 33 for g in got}) > 3
    used = {}
    for g in got:
        used.setdefault(g["sequence_id"], []).append((g["offset"], g["length"]))
    for parts in used.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0] + [n for _, n in sorted(parts)])[:-1].tolist() and sum(n for _, n in parts) <= 4096
