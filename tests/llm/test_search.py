import math

import numpy as np

from factweave.llm import bitsliced

VECTORS = "vec_id long, embedding array<float>, label int, V int, score int"


def brute(rows):
    usable = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in usable:
        if q % 4 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q and len(a) == len(b))[:10]
            out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(found)]
    return sorted(out)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.3, 16).tolist(), 0, 0, 0) for i in range(150)]
    rows += [(i, rows[i - 150][1], 0, 0, 0) for i in range(150, 170)]  # ties
    rows += [(200, None, 0, 0, 0), (204, [0.1, None] * 8, 0, 0, 0), (208, [float("nan")] * 16, 0, 0, 0), (212, [float("inf")] * 16, 0, 0, 0), (216, [0.0] * 16, 0, 0, 0), (220, [5.0, -900.0] * 8, 0, 0, 0), (224, [1.0, 2.0], 0, 0, 0), (228, [], 0, 0, 0), (232, [], 0, 0, 0), (None, [0.5] * 16, 0, 0, 0)]
    frame = spark.createDataFrame(rows, VECTORS)
    got = bitsliced.top_k(frame, frame.where("vec_id % 4 = 0"))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_fewer_rows_than_k_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0], 0, 0, 0), (1, [2.0], 0, 0, 0), (4, [-1.0], 0, 0, 0)], VECTORS)
    assert sorted(map(tuple, bitsliced.top_k(frame, frame.where("vec_id % 4 = 0")).collect())) == brute([(0, [1.0]), (1, [2.0]), (4, [-1.0])])
    none = frame.where("vec_id < 0")
    assert bitsliced.top_k(none, none).count() == 0


def test_adder_and_selection():
    rng = np.random.default_rng(6)
    numbers = rng.integers(0, 1000, (7, 64 * 3))
    adder = bitsliced.Adder()
    for row in numbers:
        for bit in range(10):
            adder.add(np.packbits((row >> bit & 1).astype(np.uint8), bitorder="little").view("<u8")[None, :].copy(), bit)
    slices = adder.slices(np.zeros((1, 3), np.uint64))
    total = sum((np.unpackbits(s.view(np.uint8), bitorder="little").astype(np.int64) << k for k, s in enumerate(slices)))
    assert (total == numbers.sum(axis=0)).all()
    everything = np.full((1, 3), ~np.uint64(0))
    for k in (1, 5, 192):
        assert bitsliced.kth_largest(slices, everything, k)[0] == np.sort(total)[-k]
        cut = np.sort(total)[-k]
        near = np.unpackbits(bitsliced.at_least(slices, everything, np.array([cut])).view(np.uint8), bitorder="little")
        assert (near.astype(bool) == (total >= cut)).all()


def test_many_blocks_of_rows_and_queries_and_narrow_ids(spark, monkeypatch):
    monkeypatch.setattr(bitsliced, "ROWS", 40)
    monkeypatch.setattr(bitsliced, "QUERIES", 7)
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(0, 0.3, 8 if i % 9 else 3).tolist(), 0, 0, 0) for i in range(330)]
    rows += [(4, rng.normal(0, 0.3, 8).tolist(), 0, 0, 0), (4, rng.normal(0, 0.3, 3).tolist(), 0, 0, 0)]  # an id three times
    frame = spark.createDataFrame(rows, VECTORS.replace("vec_id long", "vec_id int"))
    got = bitsliced.top_k(frame, frame.where("vec_id % 4 = 0"))
    assert dict(got.dtypes)["vec_id"] == "bigint"
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_long_vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0, 0.1, 3000).tolist(), 0, 0, 0) for i in range(30)]
    frame = spark.createDataFrame(rows, VECTORS)
    assert sorted(map(tuple, bitsliced.top_k(frame, frame.where("vec_id % 4 = 0")).collect())) == brute(rows)
