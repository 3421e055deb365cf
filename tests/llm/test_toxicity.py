from itertools import combinations

import numpy as np
import pytest

from tripspark.llm import toxicity as t

SF01 = "/root/testdata/sf0.01"


def brute_kernel(a, b):
    def phi(s):
        out = {}
        for i, j, k in combinations(range(len(s)), 3):
            if k - i < t.SPAN:
                u = s[i] + s[j] + s[k]
                out[u] = out.get(u, 0) + t.DECAY ** (k - i + 1)
        return out
    x, y = phi(a), phi(b)
    norm = [sum(t.DECAY ** (2 * (k - i + 1)) for i, j, k in combinations(range(len(s)), 3) if k - i < t.SPAN) for s in (a, b)]
    return sum(x[u] * y.get(u, 0) for u in x) / np.sqrt(np.maximum(norm[0], 1e-9) * np.maximum(norm[1], 1e-9))


def test_kernel_is_the_gapped_subsequence_kernel():
    words = ["idiot", "idxiot", "moron", "the", "aaaa", "réeuxpa", "pathetic"]
    got = t.kernel(words, words)
    want = np.array([[brute_kernel(a, b) for b in words] for a in words])
    assert np.allclose(got, want, atol=1e-9)
    assert got[0, 1] > 5 * got[0, 2]


def test_table_equals_the_sum_over_landmarks():
    marks, alpha = ["idiot", "clown", "thing"], np.array([1.5, 0.7, -0.4])
    table = np.zeros(t.LETTERS ** 3)
    who, what, weight = t._subsequences(marks)
    np.add.at(table, what, weight * alpha[who])
    text = "The IDIOT, c.l.o.w.n i d i o t things"
    buf = np.frombuffer(text.encode(), np.uint8)
    letter, unit, first = t.letters_of(buf, np.array([0, len(buf)]))
    chars = t._representatives()
    assert t._spelled(letter, unit, chars) == ["the", "idiot", "clown", "idiot", "things"] and first.tolist() == [0, 5]
    want = t.kernel(["the", "idiot", "clown", "idiot", "things"], marks) @ alpha + 0.25
    assert np.allclose(t.margins(letter, unit, table.astype(np.float32), 0.25), want, atol=1e-5)


def test_units_stay_inside_their_text():
    buf = np.frombuffer("a bx c d".encode(), np.uint8)
    letter, unit, first = t.letters_of(buf, np.array([0, 0, 3, 5, 8]))
    assert t._spelled(letter, unit, t._representatives()) == ["ab", "x", "cd"] and first.tolist() == [0, 0, 1, 2, 3]


@pytest.fixture(scope="module")
def model(spark):
    labels = spark.read.parquet(f"{SF01}/labels.parquet").filter("pmod(crc32(cast(doc_id as string)), 3) <> 1")
    return t.train(spark.read.parquet(f"{SF01}/documents.parquet"), labels)


def test_held_out_accuracy(spark, model):
    labels = spark.read.parquet(f"{SF01}/labels.parquet").filter("pmod(crc32(cast(doc_id as string)), 3) = 1")
    rows = t.score(spark.read.parquet(f"{SF01}/documents.parquet"), model).join(labels, "doc_id").select("score", "toxic").collect()
    toxic, clean = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    assert np.mean([np.mean(np.array(clean) < x) for x in toxic]) > 0.85
    assert np.mean(np.array(clean) >= 0.7) < 0.05


def test_spoilt_insults_rank_above_clean_text(make_docs, model):
    pairs = [(1, "you are an i d i o t now"), (2, "you are an id*iot now"), (3, "you are an idxiot now"), (4, "you are an entity now")]
    s = {r.doc_id: r.margin for r in t.score(make_docs(pairs), model).collect()}
    assert s[1] == s[2] and s[1] > s[3] > s[4]


def test_nulls_empty_long_and_repeated(make_docs, model):
    pairs = [(1, None), (2, ""), (3, "..."), (None, "idiot"), (4, "idiot"), (4, "idiot"), (5, "word " * 50_000), (6, "z" * 200_000)]
    rows = [(r.doc_id, r.score) for r in t.score(make_docs(pairs), model).collect()]
    assert len(rows) == len(pairs) and all(0 <= s <= 1 for _, s in rows)
    assert len({s for d, s in rows if d in (1, 2, 3)}) == 1 and len({s for d, s in rows if d in (None, 4)}) == 1


def test_without_labels(spark, make_docs):
    docs = make_docs([(1, "a b"), (2, "c")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in t.score(docs, t.train(docs, none)).collect()] == [0.0, 0.0]
    ones = spark.createDataFrame([(1, 1), (2, None), (None, 1)], "doc_id long, toxic int")
    assert [r.score for r in t.score(docs, t.train(docs, ones)).collect()] == [1.0, 1.0]
    assert t.score(make_docs([]), t.train(docs, none)).count() == 0


def test_a_toxic_text_gives_all_its_units_up_to_25(make_docs, spark, monkeypatch):
    rare = ["".join(chr(97 + (7 * k + 3 * i * i) % 26) for i in range(5)) + chr(97 + k) for k in range(25)]
    docs = make_docs([(1, " ".join(rare)), *[(k, "some plain words of a clean text") for k in range(2, 40)]])
    labels = spark.createDataFrame([(k, int(k == 1)) for k in range(1, 40)], "doc_id long, toxic int")
    seen = []
    fit = t._fit
    monkeypatch.setattr(t, "_fit", lambda negatives, hard, mine, *a: (seen.append({r.unit for r in mine}), fit(negatives, hard, mine, *a))[1])
    t.train(docs, labels)
    assert len(set(rare)) == 25 and seen and all(s == set(rare) for s in seen)


def names(read, *texts):
    data = [x.encode() for x in texts]
    letter, unit, first = read(np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in data]))))
    out = t._spelled(letter, unit, t._representatives())
    return [out[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]


def test_units_of_a_long_run_overlap():
    run = "".join(chr(97 + k * 7 % 26) for k in range(70))
    for text in (run, " ".join(run)):
        (got,) = names(t.letters_of, text)
        assert got == [run[a:a + 24] for a in (0, 12, 24, 36, 48)]
        (short,) = names(t.joined_of, text)
        assert all(any(run[a:a + 9] in w for w in short) for a in range(62))


def test_neighbours_are_taken_together():
    assert names(t.joined_of, "an id iot", "", "x", "wor thless extraordinarily") == [["anid", "idiot", "anidiot"], [], [], ["worthless"]]


def test_split_and_crossing_insults_rank_with_the_whole_ones(make_docs, model):
    pairs = [(1, "you are an idiot now"), (2, "you are an id iot now"), (3, "you are an entity now"), (4, "he is stu pid"), (5, "a wor thless thing"),
             (6, " ".join("thereweresomanyofthemidiotinthehouse")), (7, "thereweresomanyofthemidiotinthehouse"), (8, " ".join("thereweresomanyofthemapplesinthehouse"))]
    assert "thereweresomanyofthemidiot".index("idiot") < 24 < "thereweresomanyofthemidiot".index("idiot") + 5
    rows = {r.doc_id: r for r in t.score(make_docs(pairs), model).collect()}
    s = {d: r.margin for d, r in rows.items()}
    assert s[1] == s[2] and rows[2].log_hits > 0 and min(s[2], s[4], s[5]) > max(0, s[3]) and min(s[6], s[7]) > max(0, s[8])
