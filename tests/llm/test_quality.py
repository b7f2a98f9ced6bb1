import re

import numpy as np

from factweave.llm import quality

DOCS = "doc_id long, text string, kept string, Text string"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    dup = sum(1 for i, x in enumerate(lines) if x in lines[:i])
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)


def test_base_statistics_equal_brute_force():
    texts = [None, "", " \n", "a b c d e a b c d e f", "x\n\nx\n y\nx ", "a b c|d <e> #1", "r " * 60, "one two three four five six seven eight nine ten " * 3, "ÉÀ!! OK!! 　 z"]
    for text in texts:
        assert quality.statistics(text.encode() if text else None)[:5] == brute(text), text


def test_forest_isolates_outliers():
    rng = np.random.default_rng(4)
    rows = np.concatenate([rng.normal(0, 1, (500, 3)), rng.normal(9, 1, (10, 3))])
    score = quality.IsolationForest(rows).score(rows)
    assert score[500:].min() > np.quantile(score[:500], 0.98)


def plain_score(forest, row):
    """Mean path length by walking every tree, one split at a time."""
    total = 0.0
    for feature, cut, left, right, path, _ in forest.trees:
        at = 0
        while left[at] != at:
            at = left[at] if row[feature[at]] < cut[at] else right[at]
        total += path[at]
    n = forest.size
    usual = 2 * sum(1 / i for i in range(1, n)) - 2 * (n - 1) / n
    return 2 ** (-total / len(forest.trees) / usual)


def test_scores_equal_a_walk_down_every_tree():
    rng = np.random.default_rng(9)
    rows = rng.normal(0, 1, (400, 4))
    forest = quality.IsolationForest(rows, trees=30, tree_rows=64)
    assert np.allclose(forest.score(rows[:50]), [plain_score(forest, r) for r in rows[:50]], rtol=2e-3)
    for feature, cut, left, right, path, depth in forest.trees:
        assert path.max() <= depth + quality._mean_path(64) and len(set(feature.tolist())) > 1


def test_threshold_weighs_labelled_good_against_bad():
    good, bad = np.linspace(0.3, 0.5, 101), np.array([0.45, 0.6, 0.7])
    assert quality.calibrated(good, bad, 50.0) == 0.55  # a lower one would lose good rows; midway to the next bad one
    assert quality.calibrated(good, bad, 0.1) < 0.45
    assert quality.calibrated(good, bad[:0], 50.0) == 0.55  # without bad ones: half as far again from the middle


def corpus(spark):
    prose = "The quick brown fox number {0} runs over some lazy dog while it rains in town {0} and nobody else looks out"
    rows = [(i, prose.format(i), "clash", "clash") for i in range(200)]
    rows += [(200 + i, " ".join(f"w{i}{k}!! X | $$$" for k in range(30)), "clash", "clash") for i in range(12)]
    rows += [(300, None, "x", "x"), (301, "", "x", "x"), (302, "too few words", "x", "x"), (303, "same " * 100, "x", "x"), (None, prose.format("none"), "x", "x"), (5, prose.format(5), "x", "x")]
    labels = [(i, 1) for i in range(100)] + [(200 + i, 0) for i in range(6)] + [(None, 1), (7, None), (3, 1)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int"), rows


def test_judgement_and_kept_documents_agree(spark):
    docs, labels, rows = corpus(spark)
    model = quality.fit(docs, labels)
    got = quality.judge(docs, model).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        n, chars, symbols, dup, repeated = brute(text[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeated)
        assert r["base_failed"] == (n < 10 or 100 * repeated > 20 * n)
        assert not (r["base_failed"] and r["kept"])
    kept = [r["doc_id"] for r in got if r["kept"]]
    assert set(range(200)) <= set(kept) and not set(range(200, 212)) & set(kept)
    rest = quality.kept_documents(docs, model)
    assert rest.columns == docs.columns and sorted(map(str, kept)) == sorted(str(r["doc_id"]) for r in rest.collect())


def test_without_labels_or_documents(spark):
    docs, labels, _ = corpus(spark)
    free = quality.fit(docs, labels.where("quality > 5"))
    assert quality.judge(docs, free).where("not kept and not base_failed").count() == 0
    none = docs.where("doc_id < 0")
    assert quality.judge(none, quality.fit(none, labels)).count() == 0


def test_verdicts_are_the_forests(spark):
    """Without the forest, or with labels the other way round, other documents are kept."""
    docs, labels, rows = corpus(spark)
    model = quality.fit(docs, labels)
    by_method = {str(r["doc_id"]): r["kept"] for r in quality.judge(docs, model).where("not base_failed").collect()}
    assert not all(by_method.values()) and all(r["kept"] for r in quality.judge(docs, quality.Model()).where("not base_failed").collect())
    low = quality.Model(model.forest, float(np.median(model.forest.score(np.array([quality.statistics(r[1].encode())[5:] for r in rows[:200]])))))
    assert quality.judge(docs, low).where("kept").count() < sum(by_method.values())
    measures = np.array([quality.statistics(r[1].encode())[5:] for r in rows[:212]])
    assert ((measures > 0).sum(axis=1) >= 4).all()  # no range: every document has its measures


def test_repeated_ids_count_once_and_long_texts_are_read_whole(spark):
    docs, labels, _ = corpus(spark)
    long = "plain words of a long text that goes on and on " * 50_000
    more = docs.union(spark.createDataFrame([(7, "a row with the id of another row and with more than ten words", "x", "x")] * 500 + [(900, long, "x", "x"), (901, long + "| X!! " * 200_000, "x", "x")], DOCS))
    model = quality.fit(more, labels)
    got = {r["doc_id"]: r for r in quality.judge(more.where("doc_id >= 900"), model).collect()}
    assert got[900]["n_words"] == 550_000 and got[901]["n_symbols"] == 200_000
    assert model.threshold == quality.fit(more.union(docs.where("doc_id = 7")), labels).threshold


def test_every_row_trains_or_calibrates(spark, monkeypatch):
    """Of more documents than any bound, all without a label are in trees, and all labelled ones in the threshold."""
    dealt, told, grown, threshold = [], [], quality.grown, quality.threshold
    monkeypatch.setattr(quality, "grown", lambda sample, *a: dealt.append(sample.count()) or grown(sample, *a))
    monkeypatch.setattr(quality, "threshold", lambda scores, cost: told.append(scores.count()) or threshold(scores, cost))
    words = "concat_ws(' ', transform(sequence(1, 12), k -> concat('w', id * 13 + k, '.')))"
    docs, labels = spark.range(20_000).selectExpr("id AS doc_id", f"{words} AS text"), spark.range(9_000).selectExpr("id AS doc_id", "cast(id % 10 > 0 AS int) AS quality")
    model = quality.fit(docs, labels, trees=7)
    assert dealt == [11_000] and told == [9_000] and model.forest.size == round(11_000 / 7)
    again = quality.fit(docs.repartition(3), labels, trees=7)
    assert again.threshold == model.threshold and all((x[1] == y[1]).all() for x, y in zip(model.forest.trees, again.forest.trees))


def test_threshold_of_a_table_is_that_of_the_arrays(spark):
    rng = np.random.default_rng(3)
    for good, bad in ((rng.normal(0.4, 0.03, 700), rng.normal(0.5, 0.04, 90)), (np.round(rng.normal(0.4, 0.03, 300), 2), np.round(rng.normal(0.4, 0.04, 90), 2)), (np.array([0.3]), np.array([0.2, 0.2])), (rng.normal(0.4, 0.03, 51), np.zeros(0))):
        table = spark.createDataFrame([(1, float(x)) for x in good] + [(0, float(x)) for x in bad], "quality int, score double")
        for cost in (50.0, 0.5):
            assert np.isclose(quality.threshold(table, cost), quality.calibrated(good, bad, cost), rtol=0, atol=1e-12)
    assert quality.threshold(table.where("quality = 0"), 50.0) is None
