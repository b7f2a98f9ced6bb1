import random

import numpy as np
import xxhash

from factweave.llm import components, simhash

DOCS = "doc_id long, text string, Text string, fp long"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(links, nodes):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


def test_fingerprint_equals_bit_by_bit_majority():
    for text in [None, "", " \t\n", "one", "one two", "A b c É d e f g", "x y z " * 50, "Very long " * 5000]:
        assert simhash.fingerprint(text.encode() if text else None) == brute_fingerprint(text)


def test_golay_code_is_perfect_and_anchors_cover():
    words, leaders, near = simhash._golay()
    assert len(set(words.tolist())) == 4096 and len(leaders) == 2048
    weights = np.bitwise_count(words)
    assert sorted(set(weights.tolist())) == [0, 7, 8, 11, 12, 15, 16, 23]
    rng = np.random.default_rng(1)
    for fp in rng.integers(0, 1 << 63, 50).tolist():
        home, mine = simhash.anchors(fp)
        assert home in mine and len(set(mine.tolist())) == len(mine)
        for i, j in rng.integers(0, 64, (40, 2)).tolist():
            other = fp ^ (1 << i) ^ (1 << j if i != j else 0)
            assert home in simhash.anchors(other)[1]


def test_linked_small_and_large_groups_agree_with_brute_force():
    rng = np.random.default_rng(2)
    for n in (1, 2, 40, 700):
        base = rng.integers(0, 1 << 62, max(1, n // 8), dtype=np.uint64)
        values = np.unique(np.concatenate([base, base[rng.integers(0, len(base), n)] ^ (np.uint64(1) << rng.integers(0, 30, n, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 30, n, dtype=np.uint64))]))
        close = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= 2)
        want = reachable(close.tolist(), range(len(values)))
        assert simhash.linked(values).tolist() == [want[i] for i in range(len(values))]


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 9), (9, 10), (20, 21), (7, 7), (21, 20), (10, 11), (11, 12), (12, 13), (13, 2)]
    nodes = {n for l in links for n in l}
    frame = spark.createDataFrame([*links, (None, 1)], "a long, b long")
    assert {r["node"]: r["root"] for r in components.components(frame).collect()} == reachable(links, nodes)
    assert components.components(frame.where("a < 0")).count() == 0
    chain = spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long")
    assert {r["root"] for r in components.components(chain).collect()} == {0}


def test_near_duplicates_agree_with_brute_force(spark):
    body = " ".join(f"w{i}" for i in range(400))
    texts = [body, body + " tail", "head " + body, body.upper(), None, "", " ", "short", "short", "quite other words here", body.replace("w7 ", "x7 ")]
    rows = [(i + 100, t, "other", 1) for i, t in enumerate(texts)] + [(100, body, "again", 2), (None, body, "no id", 3)]
    docs = spark.createDataFrame(rows, DOCS)
    fps = {i: brute_fingerprint(t) for i, t, *_ in rows if i is not None}
    links = [(a, b) for a in fps for b in fps if bin(fps[a] ^ fps[b]).count("1") <= 2]
    want = reachable(links, fps)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == (100 if r["doc_id"] is None else want[r["doc_id"]])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.collect()) == sorted(set(want.values()))
    assert simhash.near_duplicates(docs.where("doc_id < 0")).count() == 0


def test_one_row_of_each_component_whatever_the_ids(spark):
    texts = [" ".join(f"{c}{i}" for i in range(200)) for c in "abcdef"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (7, texts[4]), (8, texts[2]), (9, texts[5]), (9, texts[5]), (None, None)]
    docs = spark.createDataFrame([(i, t, "x", None) for i, t in rows], DOCS)
    got = [(r[0], r[1]) for r in simhash.one_of_each(docs).collect()]
    assert sorted(got, key=str) == sorted([(None, texts[0]), (None, texts[1]), (8, texts[2]), (7, texts[3]), (7, texts[4]), (9, texts[5]), (None, None)], key=str)


def five(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def planted(seed=4):
    """Texts of 300 words, and for each of them copies with every so many words replaced."""
    r = random.Random(seed)
    rows = []
    for k in range(40):
        words = [f"w{r.randrange(3000)}" for _ in range(300)]
        rows.append((10 * k, " ".join(words)))
        for n, changes in enumerate((1, 2, 4, 5, 6, 20), 1):
            copy = list(words)
            for at in r.sample(range(300), changes):
                copy[at] = f"x{r.randrange(10**6)}"
            rows.append((10 * k + n, " ".join(copy)))
    rows += [(1000 + n, " ".join(f"g{i if i % 60 else i * 1000 + n}" for i in range(1, 400))) for n in range(120)]  # a large group
    return rows


def test_stage_links_five_word_shingles_of_similarity_from_0_8(spark):
    import corpus_pipeline

    rows = planted() + [(2000, None), (2001, ""), (2002, "a b"), (2003, "a b"), (2004, "a c")]
    sets = {i: five(t or "") for i, t in rows}
    sim = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b and a // 10 == b // 10 or a < b and 1000 <= a < b < 2000}
    links = [p for p, s in sim.items() if s >= 0.8]
    want = reachable(links, sets)
    assert len([s for s in sim.values() if 0.8 <= s < 0.95]) > 80
    docs = spark.createDataFrame([(i, t, "x", None) for i, t in rows], DOCS)
    got = {r[0] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert got == set(want.values())


def test_hot_anchors_and_bands_are_split_without_loss(spark, monkeypatch):
    """With limits so low that every group is hot, the same links and components come out."""
    import corpus_pipeline
    from factweave.llm import shingles

    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 62, 40)
    values = np.unique(np.concatenate([base, base[rng.integers(0, 40, 300)] ^ (1 << rng.integers(0, 60, 300)) ^ (1 << rng.integers(0, 60, 300))])).tolist()
    distinct = spark.createDataFrame([(v,) for v in values], "fp long")
    want = reachable([(a, b) for a in values for b in values if bin(a ^ b).count("1") <= 2], values)
    for hot in (1 << 17, 1):
        monkeypatch.setattr(simhash, "HOT_ANCHOR", hot)
        links = [tuple(r) for r in simhash.fingerprint_links(distinct).collect()]
        assert reachable(links, values) == want
    rows = planted()
    docs = spark.createDataFrame([(i, t, "x", None) for i, t in rows], DOCS)
    kept = {r[0] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    monkeypatch.setattr(shingles, "PART", 3)
    assert {r[0] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == kept


def test_long_texts(spark):
    words = [f"w{i * i % 9973}" for i in range(300_000)]
    rows = [(0, " ".join(words), "x", None), (1, " ".join(words[:-1]), "x", None), (2, " ".join(words[:200_000]), "x", None)]
    docs = spark.createDataFrame(rows, DOCS)
    assert {r["doc_id"]: r["fp"] for r in simhash.near_duplicates(docs).collect()}[0] == simhash._signed(brute_fingerprint(rows[0][1]))


def test_stage_links_by_fingerprints_and_checks_them(spark, monkeypatch):
    """SimHash alone finds copies that differ little; what it proposes in error is not linked."""
    import corpus_pipeline
    from factweave.llm import shingles

    body = [f"w{i}" for i in range(4000)]
    rows = [(1, " ".join(body)), (2, " ".join([*body[:2000], "x", *body[2001:]])), (3, "quite another text of some words"), (4, " ".join(body).upper()), (5, None), (6, " ")]
    seen, links = [], simhash.fingerprint_links
    monkeypatch.setattr(simhash, "fingerprint_links", lambda d: seen.append(d.count()) or links(d))
    hashes = [shingles.shingle_hashes(t.lower().encode().split(), 5) for _, t in rows[:2]]
    assert bin(simhash.majority(hashes[0]) ^ simhash.majority(hashes[1])).count("1") <= 2 and simhash.majority(hashes[0]) == simhash.fingerprint(rows[0][1].encode(), 5)
    docs = spark.createDataFrame([(i, t, "x", None) for i, t in rows], DOCS)
    kept = lambda: sorted(r[0] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    majority = simhash.majority
    monkeypatch.setattr(simhash, "majority", lambda hashes: 0)
    assert kept() == [1, 3, 5]
    monkeypatch.setattr(simhash, "majority", majority)
    monkeypatch.setattr(shingles, "bands", lambda hashes: ([], []))
    assert kept() == [1, 3, 5] and len(seen) == 2


def copies(seed, n, most, name, words=150):
    """Texts that differ from one origin in up to ``most`` words each: replaced, inserted or left out."""
    r = random.Random(seed)
    origin = [f"{name}{r.randrange(3000)}" for _ in range(words)]
    rows = []
    for _ in range(n):
        copy = list(origin)
        for k in range(r.randrange(most + 1)):
            at = r.randrange(len(copy))
            copy[at : at + r.choice((1, 1, 1, 0))] = r.choice(([f"x{r.randrange(10**6)}"],) * 3 + ([],))
        rows.append(" ".join(copy))
    return rows


def test_large_groups_of_near_copies_take_few_comparisons_and_lose_no_link(spark, monkeypatch):
    """Pairs that are compared grow with the texts, not with the square of a group; what is linked equals brute force."""
    import corpus_pipeline
    from factweave.llm import shingles

    # One loose group; and one that two tight families make, apart from each other.
    texts = copies(1, 400, 8, "w")
    base = copies(2, 1, 0, "v")[0].split()
    for k, step in enumerate((1000, 9)):
        family = [f"f{k}-{i}" if i % step == 0 else w for i, w in enumerate(base)]
        texts += [" ".join([*family[: n + 1], f"y{k}-{n}", *family[n + 2 :]]) for n in range(100)]
    rows = list(enumerate(texts))
    sets = {i: five(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = set(reachable(links, sets).values())
    assert len(want) > 100 and len(links) > 5000
    docs = spark.createDataFrame([(i, t, "x", None) for i, t in rows], DOCS)
    compared, checked = [], shingles._checked
    monkeypatch.setattr(shingles, "_checked", lambda pairs, *a: compared.append(pairs.count()) or checked(pairs, *a))
    assert {r[0] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == want
    assert sum(compared) < 10 * len(rows)


def test_differences_from_pivots_find_what_all_pairs_find(spark, monkeypatch):
    """With every band a large one, in parts or not, the links are those of brute force."""
    import corpus_pipeline
    from factweave.llm import shingles

    rows = planted(7) + list(enumerate(copies(3, 120, 10, "w", 60), 5000))
    sets = {i: five(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    docs = spark.createDataFrame([(i, t, "x", None) for i, t in rows], DOCS)
    monkeypatch.setattr(shingles, "LARGE", 1)
    for part in (shingles.PART, 3):
        monkeypatch.setattr(shingles, "PART", part)
        assert {r[0] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == set(reachable(links, sets).values())
