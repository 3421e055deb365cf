"""Quality classifier: context vectors against a plain loop, temperature against a grid, held-out rows, odd inputs."""
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from tripspark.llm import quality_classifier as qc
from tripspark.llm.queries import op12_quality_classifier, table

TEXTS = ["One two, three!! one two", "a", "", None, "xx " * 2000, "éa 12ab  ,,", "One two, three!! one two", "\n\t "]


def plain_words(t):
    return [w for w in re.findall(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z\x80-\xff0-9\x20\x09-\x0d]+", (t or "").encode())]


def slot_of(w, slots):
    buf = np.frombuffer(w, np.uint8)
    return int(qc.words(buf, np.array([0, len(buf)]), slots)[0][0])


def plain_table(texts, slots, dims):
    index, out = qc.index_vectors(slots, dims), np.zeros((slots, dims + 1))
    for t in texts:
        s = [slot_of(w, slots) for w in plain_words(t)]
        for i, x in enumerate(s):
            out[x, -1] += 1
            for j in range(max(0, i - qc.REACH), min(len(s), i + qc.REACH + 1)):
                if j != i:
                    out[x, :-1] += index[s[j]]
    return out


@pytest.mark.parametrize("parts", [1, 5])
def test_word_vectors(spark, make_docs, parts):
    got = qc.word_vectors(make_docs(list(enumerate(TEXTS)), parts), 512, 16)
    want = qc._vectors(plain_table(TEXTS, 512, 16))
    assert np.allclose(got.unit, want.unit) and np.allclose(got.weight, want.weight)


def test_pooled_against_plain():
    v = qc._vectors(plain_table(TEXTS, 512, 16))
    data = [(t or "").encode() for t in TEXTS]
    x = qc.pooled(np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(d) for d in data]))), v)
    for row, t in zip(x, TEXTS, strict=True):
        w = plain_words(t)
        if not w:
            assert not row.any()
            continue
        s = [slot_of(i, 512) for i in w]
        weight, unit = v.weight[s].astype(float)[:, None], v.unit[s].astype(float)
        mean = (unit * weight).sum(0) / weight.sum()
        spread = np.sqrt(np.maximum((unit ** 2 * weight).sum(0) / weight.sum() - mean ** 2, 0))
        assert np.allclose(row[:16], mean, atol=1e-4) and np.allclose(row[16:32], spread, atol=2e-3)
        assert np.allclose(row[32:], [np.log1p(len(w)), len(set(s)) / len(s), sum(a == b for a, b in zip(s, s[1:])) / len(s),
                                      sum(not re.match(rb"[A-Za-z0-9\x80-\xff]", i) for i in w) / len(w), sum(i.isdigit() for i in w) / len(w),
                                      np.log1p(sum(map(len, w)) / len(w))], atol=1e-4)


def test_temperature():
    r = np.random.default_rng(2)
    z = r.normal(0, 2, 4000)
    y = (r.random(4000) < 1 / (1 + np.exp(-z))).astype(float)
    assert abs(qc.fit_temperature(3 * z, y) - 3) < 0.3
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 400))
    best = grid[np.argmin([qc._loss(3 * z / t, y) for t in grid])]
    assert abs(np.log(qc.fit_temperature(3 * z, y) / best)) < 0.02


def test_held_out(spark):
    """On rows it didn't learn from the score parts good from bad, and its mean is near the share of label 1."""
    out = op12_quality_classifier(spark, SF01).join(table(spark, SF01, "labels"), "doc_id").filter("held_out and quality is not null").toPandas()
    y, s = out["quality"].to_numpy(), out["score"].to_numpy()
    assert (s[y == 1][:, None] > s[y == 0][None, :]).mean() > 0.95
    assert ((s >= 0.3) == y).mean() > 0.9 and abs(s.mean() - y.mean()) < 0.12


def test_no_or_one_class(spark, make_docs):
    docs = make_docs(list(enumerate(TEXTS)) + [(None, "x"), (0, "again")])
    one = spark.createDataFrame([(0, 1), (1, 1), (99, 0), (None, 0), (2, None)], "doc_id long, quality int")
    got = qc.score(docs, qc.train(docs, one, slots=512, dims=16)).collect()
    assert len(got) == len(TEXTS) + 2 and {r.score for r in got} == {1.0}
    none = qc.train(docs, one.filter("false"), slots=512, dims=16)
    assert {r.score for r in qc.score(docs, none).collect()} == {0.5}
    empty = make_docs([])
    assert qc.score(empty, qc.train(empty, one, slots=512, dims=16)).count() == 0


def test_scores_do_not_depend_on_partitions(spark, make_docs):
    r = np.random.default_rng(4)
    rows = [(k, " ".join(r.choice(["aa", "bb", "cc", "dd!!", "EE"] if k % 2 else ["uu", "vv", "ww", "xx"], 30))) for k in range(60)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    got = []
    for parts in (2, 7):
        docs = make_docs(rows, parts)
        got.append({x.doc_id: x.score for x in qc.score(docs, qc.train(docs, labels, slots=512, dims=16)).collect()})
    assert got[0].keys() == got[1].keys() and max(abs(got[0][k] - got[1][k]) for k in got[0]) < 1e-6
    assert np.mean([(v >= 0.5) == k % 2 for k, v in got[0].items()]) > 0.95


def test_contexts_word_by_word():
    """Sums of a block's contexts as counted word by word, over texts without words and pieces of a block that end inside a text."""
    r = np.random.default_rng(5)
    sizes = [0, 1, 2, 0, 3, 66_000, 1, 7, 0]
    slot, first = r.integers(0, 50, sum(sizes)), np.concatenate([[0], np.cumsum(sizes)])
    index = qc.index_vectors(64, 8)
    table, want = np.zeros((64, 9), np.int64), np.zeros((64, 9), np.int64)
    qc.add_contexts(table, index, slot, first)
    for a, b in zip(first, first[1:]):
        for i in range(a, b):
            want[slot[i], :-1] += sum(index[slot[j]].astype(np.int64) for j in range(max(a, i - 2), min(b, i + 3)) if j != i)
            want[slot[i], -1] += 1
    assert (table == want).all()
