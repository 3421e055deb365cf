"""Cross-tokenizer alignment against a plain version with dictionaries, on given documents and odd texts."""
import hashlib
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF001
from tripspark.llm import token_alignment as ta
from tripspark.llm.queries import BYTE_LEVEL, PIECES, table
from tripspark.llm.sentence_pieces import read_model

ODD = ["", None, "a", " ", "  two  spaces ", "tab\tand\nline\r\n", "mark ▁ inside", "<|endoftext|> and <s> </s> <0x41>", "日本語のテキスト", "é" * 50, "a\0b", "x" * 3000,
       "naïve café — “quotes” 👩‍👩‍👧", "it's we'll I'd", "same words here", "same words here", " lead", "trail ", "123 456,789.0"]


@pytest.fixture(scope="module")
def files():
    with open(BYTE_LEVEL, encoding="utf-8") as f:
        return f.read(), read_model(PIECES)


def brute(texts, files):
    """Per text: tokens, groups by shared end bytes, and corpus counts of linked ids."""
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(files[0])
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_proto=files[1])
    chars, rows = ta.byte_characters(), []
    for t in texts:
        want = (" " + t).encode() if t else b""
        a = [(i, bytes(chars[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + t, add_special_tokens=False).ids] if t else []
        b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()) for i in sp.encode(t)] if t else []
        if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            a = b = []
        ends = []
        for side in (a, b):
            at, mine = 0, {}
            for i, x in side:
                at += len(x)
                mine[at] = i
            ends.append(mine)
        shared = sorted(set(ends[0]) & set(ends[1]))
        groups, lo = [], 0
        for e in shared:
            groups.append("|".join(",".join(str(i) for at, i in mine.items() if lo < at <= e) for mine in ends))
            lo = e
        rows.append((len(a), len(b), [(ends[0][e], ends[1][e]) for e in shared], ";".join(groups)))
    count = Counter(x for r in rows for x in r[2])
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    return [(r[0], r[1], len(r[2]), len(r[2]), sum(count[x] == top[x[1]] for x in r[2]), sum(count[x] for x in r[2]),
             hashlib.sha256(r[3].encode()).hexdigest() if r[0] else "") for r in rows]


def run(df, files):
    return sorted((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in ta.align_corpus(df, *files).collect())


def test_documents_and_odd_texts(spark, make_docs, files, monkeypatch):
    docs = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").select("doc_id", "text").collect()]
    docs += [(10_000 + k, t) for k, t in enumerate(ODD)]
    want = brute([t for _, t in docs], files)
    assert run(make_docs(docs), files) == sorted((d[0], *w) for d, w in zip(docs, want, strict=True))


def test_units_by_themselves(files, monkeypatch):
    """Units encoded together, a few at a time or alone give a whole text's tokens."""
    texts = ["some words, with 12 numbers and it's  spaces\n\n and\tmore words " * 20, " ab\u3000cd ef", "nospace" * 100, "b", "", "x \x1c y\u00a0z é ü"]
    buf = np.frombuffer("".join(" " + t for t in texts if t).encode(), np.uint8)
    off = np.concatenate(([0], np.cumsum([len((" " + t).encode()) if t else 0 for t in texts])))
    start, plain = ta.units(buf, off)
    size = np.diff(np.append(start, len(buf)))
    assert plain.sum() > 10 and not plain.all()
    for coder in ta.coders(*files):
        want = np.concatenate(coder.encode([t for t in texts if t]))
        for joined in (8, 1 << 17):
            monkeypatch.setattr(ta, "JOINED", joined)
            ids, _, exact = ta.encode_units(coder, buf, start, size, plain)
            assert exact.all() and (ids == want).all()


def test_repeats_and_empty(spark, make_docs, files):
    docs = [(1, "same text"), (1, "same text"), (None, "same text"), (2, None)]
    want = brute([t for _, t in docs], files)
    got = sorted(run_row[1:] for run_row in ((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
                                             for r in ta.align_corpus(make_docs(docs), *files).collect()))
    assert got == sorted(want)
    assert ta.align_corpus(make_docs([]), *files).count() == 0


def test_align_on_random_cuts():
    r = np.random.default_rng(1)
    for _ in range(50):
        n = int(r.integers(1, 60))
        a, b = (np.append(np.flatnonzero(r.random(n - 1) < p) + 1, n) for p in (0.3, 0.5))
        ga, gb, last = ta.align(a, b)
        shared = np.intersect1d(a, b)
        assert (a[last] == shared).all() and (ga == np.searchsorted(shared, a)).all() and (gb == np.searchsorted(shared, b)).all()
