import random

import numpy as np

from factweave.llm import chunks

DOCS = "doc_id long, text string, start string, Digest string"


def prose(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(n)]


def test_gear_equals_the_recurrence():
    line = np.frombuffer(b"some bytes to roll over, more than thirty-two of them", np.uint8)
    h, want = 0, []
    for b in line.tolist():
        h = (2 * h + int(chunks.GEAR[b])) % (1 << 32)
        want.append(h)
    assert chunks.gear(line).tolist() == want


def test_chunks_tile_the_text_and_resist_insertions():
    words = prose(1, 4000)
    text = " ".join(words)
    first, n, start, stop, digest = chunks.chunked(text.encode())
    assert first.tolist() == [0, *np.cumsum(n)[:-1].tolist()] and n.sum() == 4000 and n.max() <= chunks.LONGEST
    for i in range(len(first)):
        assert text[start[i] : stop[i]] == " ".join(words[first[i] : first[i] + n[i]])
    changed = chunks.chunked(" ".join(["inserted", *words[:2000], "here", *words[2000:]]).encode())[4]
    assert len(set(digest.tolist()) - set(changed.tolist())) <= 8


def test_offsets_are_code_points():
    text = "é ä\n\n  ö ü " * 30
    _, _, start, stop, _ = chunks.chunked(text.encode())
    assert start[0] == 0 and text[: stop[-1]] == text.rstrip()


def test_planted_passages(spark):
    shared = [" ".join(prose(1000 + i, 55)) for i in range(20)]
    texts = {}
    for i in range(60):
        body = prose(i, 300)
        at = 17 * (i % 13) + 5
        if i < 40:
            body[at:at] = shared[i % 20].split(" ")
        texts[i] = " ".join(body)
    rows = [(i, t, "c", "c") for i, t in texts.items()] + [(100, None, "c", "c"), (101, " ", "c", "c"), (102, "word " * 5000, "c", "c")]
    got = chunks.repeated_passages(spark.createDataFrame(rows, DOCS)).collect()
    by = {r["doc_id"]: r for r in got}
    assert set(by) - {102} == set(range(40))
    for i in range(40):
        r = by[i]
        assert texts[i][r["start"] : r["stop"]] in shared[i % 20] and r["words"] >= 20
        assert r["first_doc_id"] == i % 20 and r["removed"] == (i >= 20)
    empty = spark.createDataFrame(rows, DOCS).where("doc_id < 0")
    assert chunks.repeated_passages(empty).count() == 0


def test_exact_copies_keep_the_first(spark):
    text = " ".join(prose(5, 120))
    rows = [(i, text, "c", "c") for i in (9, 3, 5)] + [(None, text, "c", "c")]
    got = {r["doc_id"]: r for r in chunks.repeated_passages(spark.createDataFrame(rows, DOCS)).collect()}
    assert set(got) == {3, 5, 9, None}
    assert not got[3]["removed"] and got[5]["removed"] and got[9]["removed"] and got[None]["removed"]
    assert all(r["words"] == 120 and r["first_doc_id"] == 3 for r in got.values())


def test_recall_by_length_against_brute_force_and_nothing_else(spark):
    """Planted passages of many lengths: a brute-force index of repeated four-word windows says what repeats."""
    r = random.Random(12)
    vocabulary = prose(99, 3000)
    body = lambda n: r.choices(vocabulary, k=n)
    texts, planted = {}, []
    for n, length in enumerate([20] * 25 + [30] * 25 + [40] * 60 + [51] * 60 + [80] * 30):
        passage = body(length)
        for k in range(2):
            before = body(r.randint(5, 120))
            texts[2 * n + k] = before + passage + body(r.randint(5, 120))
            planted.append((2 * n + k, len(before), length))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    found = {}
    for s in chunks.repeated_passages(docs).collect():
        found.setdefault(s["doc_id"], []).append((s["word"], s["word"] + s["words"]))
    windows = {}
    for i, t in texts.items():
        for at in range(len(t) - 3):
            windows.setdefault(tuple(t[at : at + 4]), []).append((i, at))
    repeated = {(i, at + k) for places in windows.values() if len(places) > 1 for i, at in places for k in range(4)}
    for i, spans in found.items():
        for a, b in spans:
            assert sum((i, at) in repeated for at in range(a, b)) >= 0.9 * (b - a)  # whole chunks, most of four words or more
    recall = {}
    for i, at, length in planted:
        assert all((i, at + k) in repeated for k in range(length))
        hit = any(a < at + length and at < b for a, b in found.get(i, []))
        recall.setdefault(length, []).append(hit)
    recall = {n: sum(x) / len(x) for n, x in recall.items()}
    assert recall[40] >= 0.9 and recall[51] >= 0.99 and recall[80] == 1.0, recall


def test_rows_of_one_id_are_texts_of_their_own(spark):
    a, b = " ".join(prose(7, 90)), " ".join(prose(8, 90))
    rows = [(1, a, "c", "c"), (1, b, "c", "c"), (1, "x y z " + a, "c", "c"), (None, b, "c", "c"), (None, b, "c", "c")]
    got = chunks.repeated_passages(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == 5 and sum(not r["removed"] for r in got) == 2
    assert all(r["words"] >= 60 and r["stop"] <= max(len(a) + 6, len(b)) for r in got) and {r["first_doc_id"] for r in got} == {1}
