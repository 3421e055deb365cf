import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tripspark.llm import license_scan as ls
from tripspark.llm import license_templates as lt
from tripspark.llm.common import text_bytes
from tripspark.llm.license_templates import MIT_BODY, TEMPLATES

WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")


def full_score(template, text):
    """Plain local alignment over all cells."""
    prev, best = [0] * (len(text) + 1), 0
    for a in template:
        row = [0]
        for j, b in enumerate(text):
            row.append(max(0, prev[j] + (2 if a == b else -1), prev[j + 1] - 1, row[j] - 1))
        best, prev = max(best, *row), row
    return best


def hashes(text):
    return ls._words(*text_bytes(pa.array([text], pa.large_string())))[3]


def test_banded_alignment_equals_the_full_one():
    rng = random.Random(3)
    for _ in range(150):
        t = [rng.randrange(12) for _ in range(rng.randrange(3, 25))]
        x = list(t)
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(x) + 1)
            x[k:k + rng.randrange(2)] = [rng.randrange(12) for _ in range(rng.randrange(2))]
        pad = [rng.randrange(12) for _ in range(rng.randrange(6))]
        text = np.array(pad + x + pad[::-1], np.uint64)
        score, matches, columns, start, end = ls.align(np.array(t, np.uint64), text, len(pad), 40)
        assert score == full_score(t, text.tolist()) and matches <= columns and 0 <= start <= end <= len(text)
        assert score == 2 * matches - (columns - matches)


def filler(rng, n):
    return " ".join(rng.choice(["the", "thion", "is", "under", "work", "éa", "software", "of"]) + rng.choice(["", "x", "y", "ing"]) for _ in range(n))


def test_planted_notices_are_found_with_their_spans(make_docs):
    rng = random.Random(5)
    pairs, want = [], {}
    for k, (name, text) in enumerate(TEMPLATES):
        before = filler(rng, rng.randrange(60))
        pairs.append((k, f"{before}\n{text.upper() if k % 2 else text}\n{filler(rng, 30)}"))
        want[k] = (name, before)
    for r in ls.scan(make_docs(pairs)).collect():
        name, before = want[r.doc_id]
        assert [m.license for m in r.matches] == [name], r
        (m,) = r.matches
        text = pairs[r.doc_id][1]
        assert m.coverage == 1.0 and m.start == len(WORD.findall(before.lower())) and m.char_start == len(before) + 1
        assert WORD.findall(text[m.char_start:m.char_end].lower()) == WORD.findall(TEMPLATES[r.doc_id][1].lower())


def test_edited_texts_and_partial_ones(make_docs):
    mit = TEMPLATES[0][1].split()
    edited = [w for k, w in enumerate(mit) if k % 17] + ["end"]
    changed = ["zz" if k % 12 == 5 else w for k, w in enumerate(mit)]
    rows = {r.doc_id: r.matches for r in ls.scan(make_docs([(1, " ".join(edited)), (2, " ".join(changed)), (3, " ".join(mit[:40])), (4, filler(random.Random(1), 500)),
                                                          (5, "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0.")])).collect()}
    assert [m.license for m in rows[1]] == ["MIT"] and 0.9 < rows[1][0].coverage < 1
    assert [m.license for m in rows[2]] == ["MIT"] and rows[3] == [] and rows[4] == []
    assert [m.license for m in rows[5]] == ["CC-BY-NC-4.0", "CC-BY-4.0"]


def test_winnowing_shares_a_fingerprint_with_every_long_enough_run():
    rng = random.Random(2)
    words = [f"w{rng.randrange(50)}" for _ in range(200)]
    for _ in range(100):
        a = rng.randrange(190)
        run = words[a:a + 5]
        x, y = hashes(" ".join(words)), hashes(" ".join(["q", *run, "r"]))
        p = set(ls.winnow(x, np.array([0, len(x)]), 3, 3)[1].tolist())
        assert p & set(ls.winnow(y, np.array([0, len(y)]), 3, 3)[1].tolist())


def test_nulls_repeats_long_and_empty(make_docs):
    line = "Released under the MIT License."
    pairs = [(1, None), (2, ""), (None, line), (3, line), (3, line), (4, "x " * 50_000 + line), (5, (line + "\n") * 300)]
    rows = [(r.doc_id, len(r.matches)) for r in ls.scan(make_docs(pairs)).collect()]
    assert sorted(rows, key=repr) == sorted([(1, 0), (2, 0), (None, 1), (3, 1), (3, 1), (4, 1), (5, 300)], key=repr)
    assert ls.scan(make_docs([])).count() == 0
    assert [len(r.matches) for r in ls.scan(make_docs([(1, line)]), templates=[("none", None), ("short", "a b")]).collect()] == [0]


def test_too_many_template_words(monkeypatch):
    monkeypatch.setattr(ls, "MOST_WORDS", 3)
    with pytest.raises(ValueError):
        ls.build_index(TEMPLATES)


def test_one_run_put_in_or_left_out_in_the_middle(make_docs):
    mit = WORD.findall(MIT_BODY.lower())
    rng = random.Random(7)
    extra = [f"extra{k}" for k in range(700)]
    pairs, want = [], {}
    for n in (9, 12, 16, 20, 21):
        pairs.append((n, " ".join(["before"] * 30 + mit[:43] + extra[:n] + mit[43:] + ["after"] * 30)))
        want[n] = (30, 30 + len(mit) + n, len(mit))
    for n in (9, 13, 17):
        pairs.append((100 + n, " ".join(["before"] * 30 + mit[:35] + mit[35 + n:] + ["after"] * 30)))
        want[100 + n] = (30, 30 + len(mit) - n, len(mit) - n)
    pairs.append((200, " ".join(mit[:43] + extra[:40] + mit[43:])))  # 87 of 127 columns: not as large a part as the coverage
    for r in ls.scan(make_docs(pairs), templates=[("MIT", MIT_BODY)]).collect():
        assert [(m.start, m.end, m.matched) for m in r.matches] == ([want[r.doc_id]] if r.doc_id in want else []), r
    assert [{m.license for m in r.matches} for r in ls.scan(make_docs(pairs[:8])).collect()] == [{"MIT"}] * 8
    long = [rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(2500)]
    pairs = [(1, " ".join(long[:1250] + extra[:9] + long[1250:])), (2, " ".join(long[:1250] + extra[:600] + long[1250:])), (3, " ".join(long[:1000] + long[1490:]))]
    rows = ls.scan(make_docs(pairs), templates=[("long", " ".join(long))]).collect()
    assert sorted((r.doc_id, [(m.start, m.end, m.matched) for m in r.matches]) for r in rows) == [(1, [(0, 2509, 2500)]), (2, [(0, 3100, 2500)]), (3, [(0, 2010, 2010)])]


def test_a_text_with_too_few_words_of_a_template_is_not_aligned(monkeypatch):
    index = ls.build_index([("MIT", MIT_BODY)])
    monkeypatch.setattr(ls, "align", lambda *a: pytest.fail("aligned"))
    h = hashes("permission is hereby granted free of charge " + "other words " * 100)
    at, prints = ls.winnow(h, np.array([0, len(h)]), 3, 3)
    assert np.isin(prints, index.prints).any() and ls.matches_of(index, h, at, prints, 0.8, 8) == []


def test_kin_of_a_license_are_named_right_or_not_at_all(make_docs):
    header = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} General Public License as "
              "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
    want = [(header.format("Affero", "3"), ["AGPL-3.0"]), (header.format("Lesser", "2.1"), ["LGPL-2.1"]), (header.format("Lesser", "3"), ["LGPL-3.0"]),
            (header.format("", "2"), ["GPL-2.0"]), (header.format("", "3"), ["GPL-3.0"]), (header.format("", "4"), []), (header.format("Other", "3"), []),
            ("Licensed under CC BY 3.0.", ["CC-BY-3.0"]), ("Licensed under CC BY 4.0.", ["CC-BY-4.0"]), ("Licensed under CC BY 1.0.", []),
            ("Licensed under CC BY-NC-SA 2.5.", ["CC-BY-NC-SA-2.5"]), ("Licensed under the XYZ License.", []), ("Licensed under the Apache License, Version 2.1.", []),
            ("Licensed under the Apache License, Version 2.", ["Apache-2.0"]), ("Licensed under CC BY 4. 1 of 3", []),
            ("Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)", ["BSL-1.0"]),
            (lt.BOOST_BODY, ["BSL-1.0"]), (f"{lt.BSD_BODY} {lt.BSD_DISCLAIMER}", ["BSD-2-Clause"]),
            (f"{lt.BSD_BODY} {lt.BSD_THIRD_CLAUSE.replace('the copyright holder', 'Example Inc')} {lt.BSD_DISCLAIMER}", ["BSD-3-Clause"]), (f"{MIT_BODY} {lt.AS_IS}", ["MIT"])]
    for pad in ("", filler(random.Random(9), 30)):
        rows = ls.scan(make_docs([(k, f"{pad}\n{t}\n{pad}") for k, (t, _) in enumerate(want)])).collect()
        for r in rows:
            assert [m.license for m in r.matches] == want[r.doc_id][1], (want[r.doc_id], r.matches)


def test_strips_of_a_long_alignment_equal_the_whole_one(monkeypatch):
    rng = random.Random(6)
    for _ in range(60):
        t = np.array([rng.randrange(9) for _ in range(rng.randrange(1, 60))], np.uint64)
        x = np.array([w for w in t for _ in range(rng.choice([0, 1, 1, 1, 1, 2]))] + [3] * rng.randrange(5), np.uint64)
        monkeypatch.setattr(ls, "STRIP", 1024)
        one, two = np.empty(len(t), np.int64), np.empty(len(t), np.int64)
        whole = ls.align(t, x, 0, 12, one)
        monkeypatch.setattr(ls, "STRIP", 3)
        assert ls.align(t, x, 0, 12, two) == whole and one.tolist() == two.tolist()
        assert (one >= 0).sum() == whole[1] and all(x[p] == w for p, w in zip(one, t, strict=True) if p >= 0)


def test_whole_licenses_from_a_folder(spark, make_docs, tmp_path):
    rng = random.Random(3)
    words = [f"w{rng.randrange(900)}" for _ in range(3000)]
    (tmp_path / "Long-1.0.txt").write_text(" ".join(words))
    (tmp_path / "Long-2.0").write_text(" ".join(words[:1500] + ["other"] * 40 + words[1500:]))
    templates = ls.read_templates(spark, str(tmp_path))
    assert [n for n, _ in templates] == ["Long-1.0", "Long-2.0"]
    texts = [" ".join(words), templates[1][1], " ".join(words[:700] + ["extra"] * 500 + words[700:])]
    rows = ls.scan(make_docs(list(enumerate(texts))), templates).collect()
    assert {r.doc_id: [m.license for m in r.matches] for r in rows} == {0: ["Long-1.0"], 1: ["Long-2.0"], 2: ["Long-1.0"]}


def test_overlaps_are_found_in_sorted_spans():
    line = "Released under the MIT License. "
    index = ls.build_index(TEMPLATES)
    h = hashes(line * 4000)
    at, prints = ls.winnow(h, np.array([0, len(h)]), 3, 3)
    found = ls.matches_of(index, h, at, prints, 0.8, 8)
    assert [(m[2], m[3]) for m in found] == [(5 * k, 5 * k + 5) for k in range(4000)]
