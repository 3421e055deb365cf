import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tripspark.llm.substring_dedup import remove_repeats

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(pairs, span=35):
    docs = [(i, WORD.findall(t or "")) for i, t in pairs]
    seen = Counter(tuple(w[j:j + span]) for _, w in docs for j in range(len(w) - span + 1))
    out = []
    for i, w in docs:
        gone = set()
        for j in range(len(w) - span + 1):
            if seen[tuple(w[j:j + span])] > 1:
                gone.update(range(j, j + span))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), kept))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=repr)


def texts(seed=3, n=60, vocabulary=400):
    rng = random.Random(seed)
    words = [f"wö{k}" if k % 7 == 0 else f"w{k}" for k in range(vocabulary)]
    base = [[rng.choice(words) for _ in range(rng.choice([5, 34, 35, 36, 80, 300]))] for _ in range(n // 2)]
    out = list(base)
    while len(out) < n:
        kind, a, b = rng.randrange(4), rng.choice(base), rng.choice(base)
        if kind == 0:
            out.append(list(a))
        elif kind == 1:
            c = list(a)
            for _ in range(3):
                c[rng.randrange(len(c))] = "edit"
            out.append(c)
        elif kind == 2:
            i = rng.randrange(len(a))
            out.append(b[:20] + a[i:i + rng.choice([34, 35, 50, 90])] + b[20:])
        else:
            out.append(a[:7] * 20 + b)
    seps = [" ", "\n", "\t ", "  ", "\r\n"]
    return [(k, rng.choice(["", " ", "\n"]) + "".join(x + rng.choice(seps) for x in w)) for k, w in enumerate(out)]


def test_equals_brute_force(make_docs):
    pairs = texts() + texts(8, 40, 3)
    pairs = [(k, t) for k, (_, t) in enumerate(pairs)]
    assert rows(remove_repeats(make_docs(pairs))) == brute(pairs)


def test_nulls_repeats_and_edges(make_docs):
    passage = " ".join(f"p{k}" for k in range(60))
    pairs = [(None, passage), (1, None), (2, ""), (3, " \n\t"), (4, "short text"), (4, "short text"), (5, passage), (5, passage),
             (6, "x " * 5000), (7, "y" * 100_000), (8, passage + " end")]
    got = remove_repeats(make_docs(pairs))
    assert rows(got) == brute(pairs)
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in got.collect()}
    assert spans[8] == [(0, 60)] and spans[6] == [(0, 5000)] and spans[4] == []


def test_empty_table(make_docs):
    assert remove_repeats(make_docs([])).count() == 0


def test_digest(make_docs):
    (row,) = remove_repeats(make_docs([(1, " a  b\n c ")])).select("kept_text", F.sha2("kept_text", 256).alias("sha")).collect()
    assert row.kept_text == "a b c" and row.sha == hashlib.sha256(b"a b c").hexdigest()


def test_small_span_and_kmer(make_docs):
    pairs = texts(5, 40, 12)
    assert rows(remove_repeats(make_docs(pairs), span=6, k=3)) == brute(pairs, 6)
