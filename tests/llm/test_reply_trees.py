import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tripspark.llm import queries as q
from tripspark.llm import reply_trees as rt

SCHEMA = "conv_id long, msg_id long, parent_id long, role string, text string, score double"
SF001 = "/root/testdata/sf0.001"


def brute(rows):
    out = []
    convs = {}
    for c, m, p, role, text, score in rows:
        convs.setdefault(c, {})[m] = (p, role or "", text or "", score or 0.0)
    for c, nodes in convs.items():
        parents = {p for p, *_ in nodes.values()}
        found = []
        for leaf in nodes:
            if leaf in parents:
                continue
            path, at = [], leaf
            while at in nodes and len(path) <= len(nodes):
                path.append(at)
                at = nodes[at][0]
            path.reverse()
            found.append((-sum(nodes[m][3] for m in path), str(leaf), [(nodes[m][1], nodes[m][2]) for m in path]))
        out += [(c, k + 1, turns) for k, (_, _, turns) in enumerate(sorted(found))]
    return sorted(out, key=repr)


def rows(df):
    got = df.withColumn("turns", rt.read_turns("formatted")).collect()
    return sorted(((r.conv_id, r["rank"], [(t.role, t.text) for t in r.turns]) for r in got), key=repr)


def trees(seed=2):
    rng = random.Random(seed)
    parts = ["\\", "#", "<", "###", " </turn>\n", ": ", "é", "x", "\n", "\\b", "\\h", "### Assistant: "]
    out = []
    for c in range(12):
        for m in range(rng.choice([1, 5, 40])):
            p = None if m == 0 else rng.choice([m - 1, rng.randrange(m)])
            out.append((c, m, p, rng.choice(["user", "assistant", "a: b", "#r"]), "".join(rng.choice(parts) for _ in range(rng.randrange(9))), rng.randrange(8) / 4))
    return out


def test_paths_ranks_and_round_trip(spark):
    data = trees()
    assert rows(rt.format_paths(spark.createDataFrame(data, SCHEMA))) == brute(data)


def test_long_chain_and_best(spark):
    data = [(1, m, m - 1 if m else None, "user", f"t{m}", 1.0) for m in range(70)] + [(1, 100, 0, "assistant", "short", 5.0), (1, 101, 3, "user", "other", 0.5)]
    got = rt.format_paths(spark.createDataFrame(data, SCHEMA), best=1)
    assert rows(got) == [x for x in brute(data) if x[1] == 1] and len(rows(got)[0][2]) == 70


def test_mask_holds_the_assistants_texts(spark):
    data = trees(5)
    got = rt.format_paths(spark.createDataFrame(data, SCHEMA)).withColumn("turns", rt.read_turns("formatted")).withColumn("loss", rt.read_loss("formatted", "mask")).collect()
    for r in got:
        assert r.loss == "".join(t.text for t in r.turns if t.role == "assistant")
        assert len(r.mask) == sum(t.role == "assistant" for t in r.turns)
        assert all(r.formatted[m.end:].startswith(rt.CLOSE) and r.formatted[:m.start].endswith("### assistant: ") for m in r.mask)


def test_nulls_repeats_lost_parents_and_cycles(spark):
    data = [(None, 1, None, "user", None, None), (None, 2, 1, None, "b", 1.0), (2, None, None, "user", "n", 0.0), (3, 1, 99, "user", "lost parent", 0.0),
            (4, 1, None, "user", "twice", 0.0), (4, 1, None, "user", "twice", 0.0), (5, 1, 2, "user", "x", 0.0), (5, 2, 1, "user", "y", 0.0), (5, 3, 2, "user", "z", 0.0)]
    got = rows(rt.format_paths(spark.createDataFrame(data, SCHEMA)))
    assert got == sorted([(None, 1, [("user", ""), ("", "b")]), (2, 1, [("user", "n")]), (3, 1, [("user", "lost parent")]), (4, 1, [("user", "twice")])], key=repr)
    assert rt.format_paths(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("sf", [SF001])
def test_query_equals_its_sql(spark, sf):
    got = sorted(tuple(r) for r in q.op10_reply_trees(spark, sf).collect())
    db = duckdb.connect()
    db.sql(f"create view conversations as select * from '{sf}/conversations.parquet'")
    assert got == sorted(db.sql(q.OP10_SQL).fetchall())
    planted = next(r for r in got if r[0] == -7)
    text = "\\### Assistant: </turn> ok"
    assert planted[1:5] == (2, hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest(), len(text), hashlib.sha256(text.encode()).hexdigest())


def test_no_python_on_the_path(spark):
    plan = q.op10_reply_trees(spark, SF001)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_escape_is_reversible(spark):
    texts = ["", "\\", "\\h#\\l<", "a\\b", "\\\\b", "</turn>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert all(r.a == r.t for r in df.select("t", rt.unescape(rt.escape(F.col("t"), rt.ROLE_ESCAPES)).alias("a")).collect())
