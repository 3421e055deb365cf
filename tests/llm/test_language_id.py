import re
from collections import Counter

import numpy as np
import pytest

from tripspark.llm import language_id as li

SF01 = "/root/testdata/sf0.01"


def brute_grams(text):
    low = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
    words = [w for w in re.split(" +", low) if w]
    out = []
    for w in words:
        padded = f" {w} "
        for n in li.LENGTHS:
            for j in range(len(padded) - n + 1):
                g = padded[j:j + n]
                if " " not in g[1:-1] and g.strip():
                    out.append(g)
    return Counter(out)


def test_grams_are_those_of_single_words():
    texts = ["Ab, cdé-1x", "", "  ", "ÉÀ\n\nlong word", "a"]
    raw = [t.encode() for t in texts]
    off = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    key, owner, letters = li.grams(np.frombuffer(b"".join(raw), np.uint8), off)
    for i, t in enumerate(texts):
        want = brute_grams(t)
        assert sorted(Counter(key[owner == i].tolist()).values()) == sorted(want.values())
        assert letters[i] == sum(c.isalpha() for c in t)


def test_filter_returns_all_languages_of_a_gram():
    rng = np.random.default_rng(1)
    members = [rng.integers(1, 1 << 62, 2000).astype(np.uint64) for _ in range(70)]
    members[3] = np.concatenate([members[3], members[69][:500]])
    f = li.make_filters([str(k) for k in range(70)], members, 1 << 16)
    for k in (0, 3, 63, 64, 69):
        got = li.count_bits(members[k], np.zeros(len(members[k]), np.int64), 1, f)[0]
        assert got[k] == len(members[k])
    both = li.count_bits(members[69][:500], np.zeros(500, np.int64), 1, f)[0]
    assert both[3] == both[69] == 500
    foreign = rng.integers(1, 1 << 62, 200_000).astype(np.uint64)
    rate = li.count_bits(foreign, np.zeros(len(foreign), np.int64), 1, f)[0] / len(foreign)
    assert np.allclose(rate, f.passing, atol=3e-3)
    _, score = li.decide(li.count_bits(foreign, np.zeros(len(foreign), np.int64), 1, f), np.array([len(foreign)]), f)
    assert score[0] <= 1


@pytest.fixture(scope="module")
def filters(spark):
    return li.train(spark.read.parquet(f"{SF01}/documents.parquet").filter("pmod(crc32(cast(doc_id as string)), 4) <> 2"))


def test_held_out_accuracy(spark, filters):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").filter("pmod(crc32(cast(doc_id as string)), 4) = 2 and length(text) > 20")
    rows = li.predict(docs, filters).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95


def test_nulls_letterless_long_and_repeated(make_docs, filters):
    pairs = [(1, None), (2, ""), (3, "12 ... %"), (None, "und der die das nicht"), (4, "a"), (5, "the and of " * 30_000), (5, "the and of " * 30_000)]
    rows = [(r.doc_id, r.lang_pred, r.score) for r in li.predict(make_docs(pairs), filters).collect()]
    got = {d: (p, s) for d, p, s in rows}
    assert len(rows) == 7 and got[1] == got[2] == got[3] == ("und", 0.0) and got[None][0] == "de" and got[5][0] == "en"
    assert all(0 <= s <= 1 for _, _, s in rows)


def test_nothing_learned(make_docs):
    empty = li.train(make_docs([]))
    assert [(r.lang_pred, r.score) for r in li.predict(make_docs([(1, "abc")]), empty).collect()] == [("und", 0.0)]
    assert li.predict(make_docs([]), empty).count() == 0
