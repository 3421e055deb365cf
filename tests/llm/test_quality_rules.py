import random
import re
from collections import Counter

import pytest

from tripspark.llm import quality_rules as q

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    size = [len(x) for x in w]
    lines = [x for x in text.split("\n")]
    seen, dup, dup_chars = set(), 0, 0
    for x in lines:
        if WORD.search(x):
            if x in seen:
                dup += 1
                dup_chars += sum(map(len, WORD.findall(x)))
            seen.add(x)
    total = sum(size)
    share = lambda x: min(1.0, x / max(total, 1))

    def grams(n):
        c = Counter(tuple(w[j:j + n]) for j in range(len(w) - n + 1))
        hit = {k for j in range(len(w) - n + 1) if c[tuple(w[j:j + n])] > 1 for k in range(j, j + n)}
        later, seen = set(), set()
        for j in range(len(w) - n + 1):
            if tuple(w[j:j + n]) in seen:
                later.update(range(j, j + n))
            seen.add(tuple(w[j:j + n]))
        top = max((k * sum(map(len, g)) for g, k in c.items() if k > 1), default=0)
        return hit, top, later
    out = {"n_words": len(w), "word_chars": total, "n_symbols": sum(x in "#*$%&|<>" for x in text), "n_dup_lines": dup,
           "n_repeat_words": len(grams(3)[0]), "dup_line_chars": share(dup_chars)}
    for n in q.TOP:
        out[f"top_{n}gram"] = share(grams(n)[1])
    for n in q.DUPLICATE:
        out[f"dup_{n}gram"] = share(sum(size[k] for k in grams(n)[2]))
    out["base_failed"] = len(w) < 50 or 100 * out["n_repeat_words"] > 50 * len(w)
    out["kept"] = (not out["base_failed"] and out["dup_line_chars"] <= q.LINES and all(out[f"top_{n}gram"] <= x for n, x in q.TOP.items())
                   and all(out[f"dup_{n}gram"] <= x for n, x in q.DUPLICATE.items()))
    return out


def texts():
    rng = random.Random(2)
    out = [None, "", " \n ", "a", "a\na", "a\n a\na\r\na", "x " * 3000, "y" * 60_000, "\n\n#é*\n\n#é*\n\n"]
    for _ in range(80):
        vocabulary = [rng.choice(["é", "a|b", "w"]) + str(k) for k in range(rng.choice([5, 40, 900]))]
        lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 7, 60]))) for _ in range(rng.choice([1, 4, 12]))]
        lines += rng.sample(lines, rng.randrange(len(lines) + 1))
        out.append(rng.choice(["\n", "\r\n", " "]).join(lines))
    return out


def test_equals_brute_force(make_docs):
    pairs = list(enumerate(texts())) + [(None, "a b c"), (3, "dup"), (3, "dup")]
    got = sorted((r.asDict() for r in q.quality(make_docs(pairs)).collect()), key=lambda r: repr((r["doc_id"], r["n_words"])))
    want = sorted(({"doc_id": i, **brute(t)} for i, t in pairs), key=lambda r: repr((r["doc_id"], r["n_words"])))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == pytest.approx(w), w


def test_ordinary_text_is_kept_and_repeats_are_not(make_docs):
    rng = random.Random(1)
    plain = " ".join(f"w{rng.randrange(800)}" for _ in range(400))
    rows = {r.doc_id: r.kept for r in q.quality(make_docs([(1, plain), (2, (plain[:600] + "\n") * 2), (3, "too short")])).collect()}
    assert rows == {1: True, 2: False, 3: False}


def test_empty_table(make_docs):
    assert q.quality(make_docs([])).count() == 0
