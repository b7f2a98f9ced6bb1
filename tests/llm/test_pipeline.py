import os
import random

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from factweave.llm import entry, packing, pii, quality, simhash


def corpus():
    r = random.Random(3)
    words = ["".join(r.choice("abcdefghijklm") for _ in range(r.randint(2, 8))) for _ in range(4000)]
    rows = []
    for i in range(120):
        text = " ".join(r.choice(words) for _ in range(r.randint(40, 160)))
        if i % 10 == 3:
            text += " write to x.y@z.example now"
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    rows += [(200 + k, rows[5][1], "en", "s0", 1) for k in range(4)]  # copies of document 5
    rows += [(300 + k, " ".join(f"{r.choice(words)}!! | $$$" for _ in range(60)).upper(), "en", "s1", 1) for k in range(8)]  # junk
    rows += [(400, None, "en", None, None), (401, "", None, "s0", 0), (402, "too short", "en", "s0", 9)]
    labels = [(i, 1, 0) for i in range(0, 100, 2)] + [(300 + k, 0, 0) for k in range(4)]
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("tables"))
    rows, labels = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    return where


def test_stages_take_effect(spark, folder):
    rows, _ = corpus()
    text = {r[0]: r[1] for r in rows}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "simhash", "personal data", "mixing", "packing"]
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        after[name] = [r.asDict() for r in docs.collect()]
        docs = spark.createDataFrame(after[name], docs.schema)
        assert name == "packing" or docs.columns == columns
    kept = {r["doc_id"] for r in after["quality"]}
    assert kept == set(range(120)) | {200, 201, 202, 203}
    fps = {i: simhash.fingerprint(text[i].encode()) for i in kept}
    first = {i: min(j for j in kept if bin(fps[i] ^ fps[j]).count("1") <= 2) for i in kept}
    assert {r["doc_id"] for r in after["simhash"]} == {i for i in kept if first[i] == i} and 200 not in {r["doc_id"] for r in after["simhash"]}
    field = pii.trained()
    for r in after["personal data"]:
        spans = pii.all_spans(text[r["doc_id"]], field)[1]
        assert ("<email>" in r["text"]) == (r["doc_id"] % 10 == 3) and bool(spans) == ("<" in r["text"])
    size = {r["doc_id"]: len(r["text"].split()) for r in after["personal data"]}
    taken: dict = {}
    for r in after["mixing"]:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert all(taken[i] <= 3 * size[i] for i in taken) and abs(sum(taken.values()) - sum(size.values())) <= 0.03 * sum(size.values())
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    tokens = sum(len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in after["mixing"])
    assert sum(r["length"] for r in after["packing"]) == tokens


def test_run_equals_the_stages(spark, folder):
    once = corpus_pipeline.run(spark, folder).select("doc_id", "piece", "length", "ids_crc32").collect()
    again = corpus_pipeline.run(spark, folder).select("doc_id", "piece", "length", "ids_crc32").collect()
    assert once and sorted(map(tuple, once)) == sorted(map(tuple, again))


def test_queries_are_registered():
    names = list(entry.queries())
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 11))
    assert set(entry.oracle_sql()) <= set(names) and corpus_pipeline.ORACLE_SQL is None
    assert quality.PROSE and os.path.exists(packing.tokenizer_path())


def test_odd_rows_pass_the_stages(spark, folder):
    """Nulls in any column, repeated rows and ids, clashing names, and no rows at all."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, Text string, _ident long"
    words = [f"w{i}" for i in range(400)]
    one, two = " ".join(words[:120]), " ".join(words[200:330])
    rows = [(None, one, None, None, None, None, None), (None, one, None, None, None, None, None), (None, two, "en", "s", 1, "x", 2), (7, one + " end", None, "s", None, "x", None), (7, two, None, "s", None, None, 3), (8, None, None, None, None, None, None), (9, "", "en", "", 0, "", 0)]
    docs = spark.createDataFrame(rows, schema)
    for stages in (corpus_pipeline.STAGES[1:4],):
        after, none = docs, docs.limit(0)
        for _, stage in stages:
            after, none = (spark.createDataFrame(stage(spark, x, folder).collect(), schema) for x in (after, none))
            assert after.columns == docs.columns and not none.take(1)
    kept = {r[0] for r in corpus_pipeline.near_duplicates(spark, docs, folder).collect()}
    assert kept <= {None, 7, 8, 9} and corpus_pipeline.pack(spark, none, folder).count() == 0
    assert corpus_pipeline.pack(spark, after, folder).count() == after.count()
