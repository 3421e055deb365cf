"""The pipeline against a plain Python version of its stages (near duplicates, decontamination, base spans, round trip)."""
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_decontaminate import words
from test_ngram_join import brute as brute_near
from test_pii import brute as brute_spans
from tripspark.llm import sentence_pieces as sp
from tripspark.llm import toxicity

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark, make_docs, tmp_path_factory):
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(500)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    item = text(14)
    base = text(120)
    pairs = [(k, text(rng.randrange(20, 80))) for k in range(40)]
    pairs += [(100, base), (101, base), (102, base + " end"), (102, base + " end"), (103, text(30) + " " + item + " " + text(9)), (104, item.upper()), (None, "null id " + text(20)),
              (105, None), (106, ""), (106, ""), (107, text(20) + " a@b.co and 1.2.3.4 " + text(20)), (108, "you idiot idiot idiot moron " + text(12))]
    pairs += [(k, f"{text(15)} idiot {text(9)} moron {text(3)}") for k in range(200, 215)]
    path = str(tmp_path_factory.mktemp("sf"))
    make_docs(pairs).write.parquet(f"{path}/documents.parquet")
    labels = [(k, 0, 1) for k in range(200, 215)] + [(k, 0, 0) for k in range(30)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, pairs, item


def test_stages_equal_the_plain_version(spark, corpus):
    path, pairs, item = corpus
    rows = corpus_pipeline.run(spark, path).collect()
    docs = spark.read.parquet(f"{path}/documents.parquet")
    scores = toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{path}/labels.parquet"))).collect()
    toxic = {r.doc_id for r in scores if r.score >= 0.7}
    assert {k for k in range(200, 215)} <= toxic and 108 in toxic and not toxic & set(range(40))
    left = [p for p in pairs if p[0] not in toxic]
    classes = {(d, c) for d, c, _ in brute_near(left)}
    kept, seen = [], set()
    for d, t in sorted(left, key=lambda p: (p[0] is None, p[0] or 0)):
        c = next(c for x, c in classes if x == d)
        if (t or "").split() and c in seen:
            continue
        seen.add(c)
        kept.append((d, t))
    w = words(item)
    windows = {tuple(w[j:j + 10]) for j in range(len(w) - 9)}
    clean = [(d, t) for d, t in kept if not any(tuple(words(t)[j:j + 10]) in windows for j in range(len(words(t))))]
    want = []
    for d, t in clean:
        for kind, a, b in sorted(brute_spans(t), key=lambda s: -s[1]):
            t = t[:a] + f"[{kind.upper()}]" + t[b:]
        want.append((d, t))
    got = [(r.doc_id, r.text) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    a = sp.automaton(sp.read_model(corpus_pipeline.PIECES))
    for r in rows:
        assert r.n_chars == (None if r.text is None else len(r.text)) and (r.ids is None) == (r.text is None)
        if r.text:
            assert b"".join(a.table[a.table_start[i]:][:a.table_size[i]].tobytes() for i in r.ids).decode()[1:] == r.text


def test_each_stage_keeps_the_columns(spark, corpus):
    path, _, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, path).columns == [*docs.columns, "ids"]


def test_clashing_names_and_repeated_rows(spark, corpus):
    path, _, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumnsRenamed({"lang": "__rid", "source": "row", "rid": "cuts"}).withColumn("__one", F.lit(1))
    copies = docs.filter("doc_id = 100").unionByName(docs.filter("doc_id = 105"))
    docs = docs.unionByName(copies).unionByName(copies)
    kept = {n: stage(spark, docs, path) for n, stage in corpus_pipeline.STAGES[:-1]}
    assert all(k.columns == docs.columns for k in kept.values())
    ids = [r.doc_id for r in kept["ngram_join"].collect()]
    assert ids.count(100) == 1 and ids.count(105) == 3 and 101 not in ids
    rows = kept["decontaminate"].filter("doc_id in (100, 103)").collect()
    assert [(r.doc_id, r["__rid"], r.row) for r in rows] == [(100, "en", "src")] * 3


def test_empty_documents(spark, corpus):
    path, _, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).count() == 0
