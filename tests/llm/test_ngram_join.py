import random
import re

import numpy as np

from tripspark.llm.graph import merge, pairs_in_groups
from tripspark.llm.common import row_hash
from tripspark.llm.ngram_join import fewest_matches, near_duplicates, text_keys

WORD = re.compile("[^\x20\x09-\x0D]+")


def grams(t, n=5):
    w = WORD.findall(t or "")
    return {tuple(w[j:j + n]) for j in range(max(1, len(w) - n + 1))} if w else set()


def brute(pairs, threshold=0.8):
    g = [grams(t) for _, t in pairs]
    near = [[b for b in range(len(pairs)) if b != a and g[a] and g[b] and len(g[a] & g[b]) >= threshold * len(g[a] | g[b]) - 1e-9]
            for a in range(len(pairs))]
    out = []
    for a in range(len(pairs)):
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        ids = [pairs[b][0] for b in seen if pairs[b][0] is not None]
        out.append((pairs[a][0], min(ids) if ids else None, len(near[a])))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in df.collect()), key=repr)


def corpus(seed=4, groups=12):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    shared = [rng.choice(words) for _ in range(40)]
    out = []
    for g in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([3, 6, 60, 150, 400]))]
        for _ in range(rng.choice([1, 2, 25])):
            t = list(base)
            for _ in range(rng.randrange(1 + max(1, len(t) // 50))):
                t[rng.randrange(len(t))] = rng.choice(words)
            if rng.random() < .3:
                t = shared + t
            out.append(" ".join(t))
    out += [out[0], out[5], out[5].replace(" ", "\n", 3)]
    rng.shuffle(out)
    return list(enumerate(out))


def test_equals_brute_force(make_docs):
    pairs = corpus()
    assert rows(near_duplicates(make_docs(pairs))) == brute(pairs)


def test_blocks_find_the_same(make_docs):
    pairs = corpus(9, 6)
    assert rows(near_duplicates(make_docs(pairs), most=7)) == brute(pairs)


def test_nulls_repeats_and_short_texts(make_docs):
    pairs = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, None), (5, ""), (5, ""), (6, "a b"), (7, "a  b"),
             (8, "x " * 20_000), (9, "x y"), (None, None)]
    assert rows(near_duplicates(make_docs(pairs))) == brute(pairs)


def test_empty_table(make_docs):
    assert near_duplicates(make_docs([])).count() == 0


def test_posterior_keeps_what_may_reach_the_threshold():
    least = fewest_matches(0.8, 1e-9)
    assert [n for n, _ in least] == [32, 64, 96, 128] and all(0 < m < 0.8 * n for n, m in least)
    assert sorted(m for _, m in least) == [m for _, m in least]


def test_pairs_in_groups():
    start, block = np.array([0, 3, 7]), np.array([0, 0, 0, 1, 1, 2, 2, 5])
    lo, hi = np.array([0] * 3 + [1] * 4 + [5]), np.array([0] * 3 + [2] * 4 + [5])
    for at_once in (1, 3, 100):
        got = [(int(a), int(b)) for x, y in pairs_in_groups(start, 8, block, lo, hi, at_once) for a, b in zip(x, y)]
        assert got == [(0, 1), (0, 2), (1, 2), (3, 5), (3, 6), (4, 5), (4, 6)]


def test_merge():
    assert merge(np.arange(6), np.array([5, 1, 3]), np.array([3, 2, 1])).tolist() == [0, 1, 1, 1, 4, 1]


def test_keys_tell_rows_and_texts_apart(spark):
    rows = [(None, "x"), ("x", None), ("", "x"), ("x", ""), ("null:", ""), (None, ""), (None, None), ("1:x", "y"), ("1", ":x=y"), ("x", None)]
    keys = [bytes(r.k) for r in spark.createDataFrame(rows, "i string, t string").select(row_hash("i", "t").alias("k")).collect()]
    assert len(set(keys)) == len(set(rows)) == 9 and keys[1] == keys[9] and {len(k) for k in keys} == {16}
    texts = ["a b", "  a\t\nb ", "ab", "a  b c", "", " ", "b a", "a", "b"]
    raw = [t.encode() for t in texts]
    keys = text_keys(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))).to_pylist()
    same = {}
    for t, k in zip(texts, keys, strict=True):
        same.setdefault(k, set()).add(" ".join(t.split()))
    assert all(len(v) == 1 for v in same.values()) and same[None] == {""} and len(same) == 7
