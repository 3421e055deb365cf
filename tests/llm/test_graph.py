import random

import pyarrow as pa
import pytest

from tripspark.llm.common import join_counted
from tripspark.llm.graph import block_pairs, components, whole_groups


def brute(edges):
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    return {u: r for u, r in label.items() if u != r}


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(4)
    ids = rng.sample(range(-10 ** 6, 10 ** 6), 60)
    edges = {"path": list(zip(ids, ids[1:])), "star": [(ids[0], x) for x in ids[1:]], "none": [],
             "random": [(rng.choice(ids), rng.choice(ids)) for _ in range(40)]}[kind]
    edges = [e for e in edges if e[0] != e[1]]
    got = components(spark, spark.createDataFrame(edges + edges[:3], "a long, b long"), "test")
    assert {r.u: r.root for r in got.collect()} == brute(edges)


def test_join_counted_salts_hot_keys(spark):
    left = spark.range(5000).selectExpr("if(id < 3000, 7, id) as k", "id as v")
    right = left.groupBy("k").count().withColumnRenamed("count", "n")
    got = join_counted(left, right, "k", "n", "v").collect()
    assert len(got) == 5000 and {r.n for r in got if r.k == 7} == {3000} and sorted(r.v for r in got) == list(range(5000))


def test_block_pairs_meet_once(spark):
    members = spark.range(50).selectExpr("1 as g", "id as m", "50 as n")
    rows = block_pairs(members, "g", "n", "m", 8).collect()
    together = {}
    for r in rows:
        together.setdefault((r.lo, r.hi), []).append(r)
    seen = [tuple(sorted((a.m, b.m))) for (lo, hi), x in together.items() for i, a in enumerate(x) for b in x[i + 1:]
            if lo == hi or a.block != b.block]
    assert len(seen) == len(set(seen)) == 50 * 49 // 2


def test_whole_groups_never_cuts_a_group():
    keys = [k for k in range(40) for _ in range(k % 7 + 1)]
    batches = [pa.RecordBatch.from_pydict({"k": keys[i:i + 5]}) for i in range(0, len(keys), 5)]
    seen = []
    for batch, start in whole_groups(iter(batches), ["k"], rows=9):
        mine = batch.column("k").to_pylist()
        assert [mine[i] for i in start] == sorted(set(mine))
        assert not set(mine) & set(seen)
        seen += mine
    assert seen == keys
