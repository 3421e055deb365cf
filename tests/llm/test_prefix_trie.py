"""Prefix trie: brute force on random conversations, rebuilt or not, with large components split by Spark and by tasks."""
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripspark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)


def sequences(rows, shared=True):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    for v in by.values():
        v.sort()
    out = {}
    for c, v in by.items():
        h = zlib.crc32(str(c).encode()) % 9 if shared else 0
        out[c] = tuple((x[2], x[3]) for x in by.get(c - c % 5, [])[:h] + v[h:])
    return out


def brute(seq):
    members, ended, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, s in seq.items():
        for k in range(len(s) + 1):
            members[s[:k]].append(c)
        ended[s].append(c)
    for s in members:
        if s:
            kids[s[:-1]].add(s)
    saved, leaves = defaultdict(int), defaultdict(int)
    for s in members:
        for k in range(len(s) + 1):
            saved[s[:k]] += (len(members[s]) - 1) * len(s[-1][1].encode()) if s else 0
            leaves[s[:k]] += s not in kids
    return sorted((min(m), len(s), min(members[s[:-1]]) if s else -1, len(m), len(kids.get(s, ())), leaves[s], saved[s],
                   hashlib.sha256(",".join(map(str, sorted(ended.get(s, [])))).encode()).hexdigest()) for s, m in members.items())


def found(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_bytes, r.ends_sha256)
                  for r in df.collect())


def random_rows(seed, convs=40, longest=12):
    r = random.Random(seed)
    rows = []
    for c in [*range(convs), None, 10**12]:
        for t in range(r.randint(1, longest)):
            rows.append((c, r.choice([t, t, t, 0, None]), r.choice(["user", "assistant", None]), r.choice(["a", "b", "é", "", None])))
    return rows + rows[:7]


def rebuilt(df):
    return prefix_trie.with_shared_heads(prefix_trie.numbered(df), 5, F.crc32(F.col("conv").cast("string")) % 9)


@pytest.mark.parametrize("most", [4, 10**6])
def test_rebuilt(spark, most):
    rows = random_rows(3)
    got = prefix_trie.summary(*rebuilt(frame(spark, rows)), most)
    assert found(got) == brute(sequences(rows))


def test_conversations_over_many_tasks(spark):
    """Coalescing off: one conversation's turns are sorted into several tasks."""
    rows = random_rows(5, 6) + [(1, t, "user", f"long {t % 7}") for t in range(300)] + [(2, t, "user", f"long {t % 7}") for t in range(200)]
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = prefix_trie.numbered(frame(spark, rows))
        places = sorted(r.place for r in numbered.filter("conv = 1").collect())
        assert places == list(range(1, len(places) + 1)) and len(places) >= 300
        assert found(prefix_trie.summary(*prefix_trie.whole(numbered), 60)) == brute(sequences(rows, shared=False))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)


def test_empty(spark):
    assert prefix_trie.build(frame(spark, [])).count() == 0
    assert prefix_trie.build(frame(spark, [(None, 1, "user", "x")])).count() == 0


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_split_all(shape):
    """Totals of a forest against sums from the deepest nodes up."""
    r = np.random.default_rng(7)
    n = 3000
    parent = {"chain": np.arange(n) - 1, "star": np.where(np.arange(n) % 50 == 0, -1, np.arange(n) // 50 * 50),
              "random": np.array([-1] + [int(r.integers(max(-1, i - 40), i)) for i in range(1, n)])}[shape]
    depth, weight = np.zeros(n, np.int64), np.ones(n, np.int64)
    values = r.integers(0, 100, (n, 2))
    want = values.copy()
    for i in range(n):
        depth[i] = depth[parent[i]] + 1 if parent[i] >= 0 else 0
    for i in range(n - 1, -1, -1):
        if parent[i] >= 0:
            weight[parent[i]] += weight[i]
            want[parent[i]] += want[i]
    assert (prefix_trie.split_all(parent, depth, weight, values) == want).all()
