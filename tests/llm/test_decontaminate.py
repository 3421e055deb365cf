import random
import re
import tracemalloc

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripspark.llm import decontaminate
from tripspark.llm.decontaminate import build_index, search, stored_index

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(t):
    return WORD.findall((t or "").translate(AZ))


def brute(docs, items, size=10):
    windows = {}
    for i, t in items:
        w = words(t)
        if w:
            n = min(size, len(w))
            for j in range(len(w) - n + 1):
                windows.setdefault(tuple(w[j:j + n]), set()).add(None if i is None else str(i))
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                who = windows.get(tuple(w[j:j + n]))
                if who:
                    hit.update(range(j, j + n))
                    found |= who
        out.append((d, len(w), len(hit), sorted(found - {None})))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, sorted({m.item for m in r.matches} - {None})) for r in df.collect()), key=repr)


def sample(seed=1):
    rng = random.Random(seed)
    vocabulary = ["The", "of", "a", "É", "ñandú", "x1"] + [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 4, 9, 10, 11, 30])))) for k in range(25)]
    docs = []
    for k in range(80):
        body = [rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 50, 200]))]
        for _ in range(rng.randrange(3)):
            w = rng.choice(items)[1].split()
            a = rng.randrange(len(w) + 1)
            body[len(body) // 2:len(body) // 2] = [x.upper() if rng.random() < .3 else x for x in w[a:a + rng.choice([5, 10, 40])]]
        docs.append((k, rng.choice([" ", "-", ".\n"]).join(body)))
    return docs + [(None, docs[5][1]), (7, docs[7][1]), (900, None), (901, "")], items + [(None, "zz yy"), (3, items[4][1]), (50, None)]


@pytest.fixture()
def tables(spark, make_docs):
    docs, items = sample()
    return docs, items, make_docs(docs), spark.createDataFrame(items, "item_id long, text string")


def test_equals_brute_force(tables, tmp_out):
    docs, items, d, i = tables
    assert got(search(stored_index(d, tmp_out + "/index"), i)) == brute(docs, items)


def test_items_in_blocks(tables):
    docs, items, d, i = tables
    index = build_index(d).cache()
    assert got(search(index, i, block_chars=60)) == brute(docs, items)


def test_runs(spark, make_docs):
    items = spark.createDataFrame([(1, "a b c d"), (2, "c d")], "item_id long, text string")
    (r,) = search(build_index(make_docs([(0, "x a b c d y c d")])), items, size=3).collect()
    assert [(m.item, m.start, m.end) for m in r.matches] == [("1", 1, 5), ("2", 3, 5), ("2", 6, 8)] and r.n_hit == 6


def test_proximity(spark, make_docs):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = make_docs([(0, "alpha x beta gamma"), (1, "alpha x y z beta gamma"), (2, "gamma beta alpha")])
    near = {r.doc_id: len(r.matches) > 0 for r in search(build_index(docs), items, slop=1).collect()}
    assert near == {0: True, 1: False, 2: False}
    assert all(not r.matches for r in search(build_index(docs), items).collect())


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert search(build_index(make_docs([])), none).count() == 0
    assert got(search(build_index(make_docs([(1, "a b")])), none)) == [(1, 2, 0, [])]


def test_query_counts_items_once(spark, make_docs):
    items = spark.createDataFrame([(10, "a b"), (9, "b c"), (9, "c d")], "item_id long, text string")
    (r,) = search(build_index(make_docs([(0, "A-b c d")])), items).select(
        F.concat_ws(",", F.array_sort(F.array_distinct(F.col("matches.item")))).alias("ids")).collect()
    assert r.ids == "10,9"


def test_several_blocks_of_an_index_that_is_not_stored(make_docs):
    """Every block must see the same segments: one row a document, its runs merged."""
    words = [f"w{i}" for i in range(40)]
    docs = make_docs([(k, " ".join(words[k:k + 25])) for k in range(5)], 2)
    items = docs.sparkSession.createDataFrame([("a", " ".join(words[5:17])), ("b", " ".join(words[10:22])), ("c", "nothing here")], "item_id string, text string")
    one = search(build_index(docs), items)
    many = search(build_index(docs), items, block_chars=20)
    rows = lambda df: sorted((r.doc_id, r.n_words, r.n_hit, sorted(map(tuple, r.matches))) for r in df.collect())
    assert len(rows(many)) == 5 and rows(many) == rows(one)


def test_row_groups_are_bounded_however_much_a_task_reads(spark, tmp_out):
    """Before, up to 100 segments of a task were one row group (24 MB here), which the next read as a whole."""
    docs = spark.range(0, 6000, 1, 1).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 250), k -> concat('w', abs(hash(id, k))))) AS text")
    index = stored_index(docs, tmp_out + "/index")
    most = 0
    for path in index.inputFiles():
        m = pq.ParquetFile(path.removeprefix("file://")).metadata
        most = max([most, *(m.row_group(k).total_byte_size for k in range(m.num_row_groups))])
    assert 0 < most < 6 << 20
    item = docs.filter("doc_id = 4321").selectExpr("doc_id AS item_id", "text")
    assert [(r.doc_id, r.n_words, r.n_hit) for r in search(index, item).filter("n_hit > 0").collect()] == [(4321, 250, 250)]


def in_process(docs, items, size=10):
    """The rows of ``docs`` as one batch, without Spark."""
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([d for d, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs])})
    query = decontaminate.query_of([t for _, t in items])
    rows = [r for part in decontaminate._search([None if i is None else str(i) for i, _ in items], query, size, 0)(decontaminate._segments(iter([batch])))
            for r in part.to_pylist()]
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], sorted({m["item"] for m in r["matches"]} - {None})) for r in rows), key=repr)


def test_items_and_candidates_in_small_steps(monkeypatch):
    docs, items = sample(2)
    monkeypatch.setattr(decontaminate, "QUERY_WORDS", 12)
    monkeypatch.setattr(decontaminate, "CANDIDATES", 3)
    monkeypatch.setattr(decontaminate, "SEGMENT_BYTES", 500)
    assert in_process(docs, items) == brute(docs, items)


def test_segments_without_words_and_with_wide_positions():
    long = " ".join(f"v{k % 70_000}" for k in range(140_000))
    docs = [(1, "!!!"), (2, None), (3, long), (4, "v1 v2")]
    assert in_process(docs[:2], [(1, "a")]) == [(1, 0, 0, []), (2, 0, 0, [])]
    assert in_process(docs, [(7, "v69998 v69999 v0 v1"), (8, "V1-v2"), (9, "")], 3) == brute(docs, [(7, "v69998 v69999 v0 v1"), (8, "V1-v2"), (9, "")], 3)


def test_windows_take_little_memory():
    """600,000 words of items, of whose windows one in 50 is in the segment: before, all windows were made
    and copied as ten hashes each (263 MB)."""
    text = " ".join(f"x{k}" for k in range(5_000))
    items = [(k, " ".join(f"x{(k * 50 + j) % 5_000}" if k % 50 == 0 else f"y{j}" for j in range(50))) for k in range(12_000)]
    tracemalloc.start()
    ((_, n, hit, who),) = in_process([(1, text)], items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (n, hit, len(who)) == (5_000, 100, 240) and peak < 120 << 20, peak
