from collections import Counter

from pyspark.sql import functions as F

from factweave.llm import mixing
from factweave.llm.common import pick

DOCS = "doc_id long, source string, text string, lang string, n_chars long, size string, Text string"


def corpus(spark):
    rows = []
    for i in range(300):
        source = "big" if i < 200 else ["a", "b", "é", None][i % 4]
        rows.append((i, source, "word " * (i % 50) if i % 17 else None, "en", 1, "clash", "clash"))
    rows += [(299, None, "again and again", "en", 15, "x", "x")] * 2 + [(None, "a", "no id", "en", 5, "x", "x"), (1000, "empty", "", "en", 0, "x", "x"), (1001, "long", "w " * 30000, "en", 60000, "x", "x")]
    return spark.createDataFrame(rows, DOCS), rows


def targets(rows):
    size = Counter()
    for r in rows:
        size[r[1]] += len((r[2] or "").split())
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    open_, left, out = set(order), float(sum(size.values())), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 3 * size[s]}
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = 3.0 * size[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return size, out


def test_targets_and_taken(spark):
    docs, rows = corpus(spark)
    size, want = targets(rows)
    ids = {(r[0], r[1]) for r in rows}
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    source = {i: s for i, s in ids}
    taken = Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == size[s] and abs(r["target"] - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.03 * t + 64, (s, taken[s], t)  # drawn: within two blocks and 3 %
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_mixed_documents_hold_the_taken_words(spark):
    docs, _ = corpus(spark)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    want = mixing.mix(docs).groupBy("doc_id").agg(F.sum("taken").alias("n")).where("n > 0")
    mixed = pick(mixed, doc_id="doc_id", text="text", n_chars="n_chars")
    words = mixed.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(r"\S+"))).alias("n"))
    assert sorted(map(str, want.collect())) == sorted(map(str, words.collect()))
    assert mixed.where("n_chars <> length(text)").count() == 0


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 3, 10, 97, 1024):
        frame = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(42), F.lit("s"), F.lit(0)).alias("p"))
        got = [r["p"] for r in frame.collect()]
        assert sorted(got) == list(range(n)) and (n < 97 or got != sorted(got))
    huge = 10**15 + 1
    got = [r["p"] for r in spark.range(200).select(mixing.permuted(F.lit(huge) - 1 - F.col("id"), F.lit(huge), F.lit(1)).alias("p")).collect()]
    assert len(set(got)) == 200 and all(0 <= p < huge for p in got) and max(got) - min(got) > huge // 2


def test_empty(spark):
    docs, _ = corpus(spark)
    assert mixing.mix(docs.where("doc_id < 0")).count() == 0
    assert mixing.mixed_documents(docs.where("doc_id < 0")).count() == 0


def test_draws_decide_what_is_taken(spark):
    """Shard counts are multinomial draws, and `taken` equals what a plain walk over the drawn slots gives."""
    docs, rows = corpus(spark)
    counts, taken = {}, {}
    for seed in (1, 2):
        options = {"seed": seed, "shard_slots": 64, "block_words": 16}
        slots = mixing.mixed_blocks(docs, **options).collect()
        counts[seed] = Counter((r["shard"], r["source"]) for r in slots)
        assert max(Counter(r["shard"] for r in slots).values()) <= 64
        used = Counter((r["source"], r["block"]) for r in slots)
        assert max(used.values()) <= 3 and len({(r["source"], r["epoch"], r["block"]) for r in slots}) == len(slots)
        places, _ = mixing._plan(mixing._documents(docs), (1, 2, 3), 3, 16, 64, seed)
        want = Counter()
        for r in places.collect():
            for at in range(r["start"], r["start"] + r["size"]):
                want[r["doc_id"], r["size"]] += used[r["source"], at // 16]
        got = mixing.mix(docs, **options).collect()
        taken[seed] = Counter()
        for r in got:
            taken[seed][r["doc_id"], r["size"]] += r["taken"]
            assert bool(r["taken"]) == bool(r["shards"])
        assert +taken[seed] == +want
        shards = {r["shard"] for r in slots}
        assert {x for r in got for x in r["shards"]} == shards and len(shards) > 20
        # A source's counts scatter from shard to shard as a binomial does.
        total = Counter(r["source"] for r in slots)
        size = Counter(r["shard"] for r in slots)
        early = [k for k in sorted(shards) if size[k] == 64][: int(0.7 * len(shards))]
        p = total["long"] / sum(total.values())
        spread = sum((counts[seed][k, "long"] - 64 * p) ** 2 for k in early) / len(early)
        assert 0.3 * 64 * p * (1 - p) < spread < 3 * 64 * p * (1 - p)
    assert counts[1] != counts[2] and taken[1] != taken[2]
    totals = [Counter() for _ in counts]
    for t, c in zip(totals, counts.values()):
        for (_, s), n in c.items():
            t[s] += n
    assert totals[0] != totals[1]  # not quotas: the totals are drawn too


def test_equal_rows_by_the_thousand(spark):
    rows = [(7, "s", "one two three four", "en", 18, "x", "x")] * 3000 + [(i, "t", "five six", "en", 8, "x", "x") for i in range(2000)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(docs)
    assert got.count() == 5000 and got.where("taken > 3 * size").count() == 0
    words = pick(mixing.mixed_documents(docs), source="source", text="text").groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"\S+"))).alias("n"))
    want = got.withColumn("source", F.when(F.col("size") == 4, "s").otherwise("t")).groupBy("source").agg(F.sum("taken").alias("n"))
    assert sorted(map(tuple, words.collect())) == sorted(map(tuple, want.collect()))
