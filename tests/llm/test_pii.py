import random
import re

import pytest
from pyspark.sql import functions as F

from tripspark.llm import pii

RX = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
      "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for kind, rx in RX.items():
        for m in re.finditer(rx, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                    or kind == "card" and 13 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def texts():
    rng = random.Random(3)
    parts = ["a@b.co", "é.x@y-z.org", "@", ".", "1.2.3.4", "0001.2.3.255", "300.1.1.1", "4111 1111 1111 1111", "4111111111111111", "1234567890123456",
             "+1 (325) 555-8094", "+49-30 1234567", " ", "x", "😀", "_", "%", "12", "-", "7.8.9.10.11.12.13.14", "a@b.c_d@e.fg", "+", "(", "\n", "é"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(400)]


def spans(df, base=None):
    return sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in r.spans if base is None or s.base == base]) for r in df.collect()), key=repr)


def test_base_spans_equal_python_matches(make_docs):
    pairs = list(enumerate(texts()))
    assert spans(pii.find(make_docs(pairs)), True) == sorted(((i, brute(t)) for i, t in pairs), key=repr)


def test_nulls_long_repeated(make_docs):
    pairs = [(1, None), (2, ""), (None, "mail a@b.co"), (3, "a@b.co"), (3, "a@b.co"), (4, "9" * 100_000), (5, "a" * 200_000 + "@"), (6, "x@y.zz 10.0.0.1 " * 3000), (7, "+" * 5000)]
    got = pii.find(make_docs(pairs))
    assert spans(got, True) == sorted(((i, brute(t)) for i, t in pairs), key=repr)
    assert pii.find(make_docs([])).count() == 0


def test_added_spans(make_docs):
    token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"
    pairs = [(k, f"wort {k} token = \"{token[k % 9:]}\" und mehr") for k in range(30)]
    pairs += [(100 + k, f"call phone (325) 555-80{k + 10} now") for k in range(20)] + [(200, "plain text without any data 12 34")]
    pairs += [(300 + k, f"write mail to jo{k} [at] mail [dot] com ok") for k in range(20)] + [(400 + k, f"order {k}000111122223333") for k in range(1, 9)]
    got = dict(spans(pii.find(make_docs(pairs)), False))
    start = pairs[3][1].index('"') + 1
    assert got[3] == [("secret", start, start + len(token) - 3)] and got[200] == [] and got[105][0][0] == "phone" and got[305][0][0] == "email"


def test_base_wins_over_overlapping_candidates(make_docs):
    got = spans(pii.find(make_docs([(1, "+1 (325) 555-8094")])))
    assert got == [(1, [("phone", 0, 17)])]


def test_redact(make_docs):
    docs = make_docs([(1, "é mail a@b.co, ip 1.2.3.4."), (2, None), (3, "clean"), (4, "4111111111111111"), (4, "4111111111111111")])
    out = sorted(((r.doc_id, r.text) for r in pii.redact(docs).collect()), key=repr)
    assert out == [(1, "é mail [EMAIL], ip [IP]."), (2, None), (3, "clean"), (4, "[CARD]"), (4, "[CARD]")]
    assert pii.redact(docs).columns == docs.columns


def test_estimate_finds_the_reliable_labeler():
    rng = random.Random(1)
    counts = {}
    for _ in range(4000):
        y = rng.random() < 0.4
        vote = lambda right: (1 if y else -1) if rng.random() < right else (-1 if y else 1)
        key = (vote(0.95), vote(0.9), vote(0.55), vote(0.8))
        counts[key] = counts.get(key, 0) + 1
    rows = [dict(zip(pii.LABELERS, k), kind="ssn", n=n) for k, n in counts.items()]
    _, rates = pii.estimate(rows)
    good, poor = (rates[x, 1][1] - rates[x, 0][1] for x in ("form", "context"))
    assert good > 0.8 and poor < 0.3


def test_logistic_regression_reaches_the_optimum():
    rng = random.Random(2)
    rows = [{x: rng.choice((-1, 0, 1)) for x in pii.LABELERS} | {"long": rng.randrange(2), "spaced": 0, "kind": rng.choice(pii.KINDS), "n": rng.randrange(1, 50)}
            for _ in range(200)]
    p = [0.9 if r["form"] + r["surroundings"] > 0 else 0.1 for r in rows]
    w = pii.fit_logistic(rows, p)
    score = lambda r: sum(a * (r[c] == v) for a, (c, v) in zip(w, pii.FEATURES)) + w[-1]
    assert sum((score(r) > 0) == (q > 0.5) for r, q in zip(rows, p)) > 170
    residual = [r["n"] * (1 / (1 + 2.718281828459045 ** -score(r)) - q) for r, q in zip(rows, p)]
    assert abs(sum(residual)) < 1e-3 * sum(r["n"] for r in rows)       # the unpenalised bias balances them


@pytest.mark.parametrize("digits", ["4111111111111111", "4111111111111112", "0", "79927398713"])
def test_luhn(spark, digits):
    assert spark.range(1).select(pii.luhn(F.lit(digits))).first()[0] == luhn(digits)


def test_no_python_on_the_path(make_docs):
    plan = pii.find(make_docs([(1, "a@b.co")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
