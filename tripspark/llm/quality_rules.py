"""Quality rules by repetition coverage: what share of a text's characters lies inside repeated n-grams and lines.

Every text is measured whole in one pass, in vectorised steps over blocks of texts: word hashes from prefix sums, rolling hashes
of each n-gram length, and a sort that finds equal hashes within a text. Longer lengths look only at texts in
which a shorter one repeats. Nothing is shuffled and nothing is learned.

Characters are code points inside words (runs of non-white-space). Null, empty and blank texts have no words: their measures are 0
and the base rule (fewer than 50 words) fails them. Rows that repeat are measured each; other columns are not
read; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import SPACE, WORD_BASE, blocks, i64, mix, small_batches, spans_hash, windows_hash, word_bounds

#: Highest share of characters in all repeats of the most covering n-gram, by n.
TOP = {2: 0.20, 3: 0.18, 4: 0.16}
#: Highest share of characters inside n-grams that occurred before in the text, by n.
DUPLICATE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Highest share of characters inside lines equal to an earlier line.
LINES = 0.30
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_GRAM = 0xC2B2AE3D27D4EB4F


def _per_text(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text, values, n).astype(np.int64)


def _groups(h: np.ndarray, text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For windows that start at ``at``: group (equal hash, same text), its size, whether an equal one stands before."""
    key = mix(h[at] ^ mix(text[at].astype(np.uint64) + np.uint64(1)))
    _, first, group, size = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    later = np.ones(len(at), bool)
    later[first] = False
    return group, size, later


def _covered(at: np.ndarray, n: int, words: int) -> np.ndarray:
    step = np.zeros(words + 1, np.int64)
    step[at] += 1
    step[at + n] -= 1  # starts are distinct, so are ends
    return np.cumsum(step[:-1]) > 0


def measure(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """All measures of the texts of a block."""
    texts = len(off) - 1
    start, end, first = word_bounds(buf, off, SPACE)
    words, n_words = len(start), np.diff(first)
    text = np.repeat(np.arange(texts), n_words)
    lead = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
    chars = lead[end] - lead[start]
    word_chars = _per_text(chars, text, texts)
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[buf])))
    out = {"n_words": n_words, "word_chars": word_chars, "n_symbols": symbols[off[1:]] - symbols[off[:-1]]}
    h = spans_hash(buf, start, end, WORD_BASE)
    share = lambda x: np.minimum(x / np.maximum(word_chars, 1), 1.0)

    # lines with a word, and those equal to an earlier one
    breaks = np.flatnonzero(buf == 0x0A)
    line_start = np.unique(np.concatenate((off[:-1], breaks + 1)))
    line_start = line_start[line_start < len(buf)]
    line = np.searchsorted(line_start, start, "right") - 1
    some = np.unique(line)
    line_end = np.minimum(np.append(line_start[1:], len(buf)), len(buf))
    closing = (line_end > 0) & np.isin(line_end - 1, breaks, assume_unique=True)
    line_end = line_end - closing
    line_text = np.searchsorted(off, line_start[some], "right") - 1
    key = mix(spans_hash(buf, line_start[some], line_end[some], WORD_BASE) ^ mix(line_text.astype(np.uint64) + np.uint64(1)))
    _, earliest = np.unique(key, return_index=True)
    again = np.ones(len(some), bool)
    again[earliest] = False
    out["n_dup_lines"] = np.bincount(line_text[again], minlength=texts)
    repeated = np.zeros(len(line_start), bool)
    repeated[some[again]] = True
    out["dup_line_chars"] = share(_per_text(chars * repeated[line], text, texts))

    total = np.concatenate(([0], np.cumsum(chars)))
    alive = np.ones(texts, bool)  # texts in which the length before repeats
    for n in sorted({3, *TOP, *DUPLICATE}):
        top, covered = np.zeros(texts), np.zeros(texts, np.int64)
        count = np.zeros(texts, np.int64)
        if words >= n:
            inside = np.flatnonzero(text[:words - n + 1] == text[n - 1:])
            at = inside[alive[text[inside]]]
            grams = windows_hash(h, n, _GRAM)
            group, size, later = _groups(grams, text, at)
            twice = size[group] > 1
            if n in TOP and twice.any():
                covers = np.bincount(group, total[at + n] - total[at])
                np.maximum.at(top, text[at[twice]], covers[group[twice]])
            count = np.bincount(text[_covered(at[twice], n, words)], minlength=texts)
            if n in DUPLICATE:
                covered = _per_text(chars * _covered(at[later], n, words), text, texts)
        alive &= count > 0
        if n == 3:
            out["n_repeat_words"] = count
        if n in TOP:
            out[f"top_{n}gram"] = share(top)
        if n in DUPLICATE:
            out[f"dup_{n}gram"] = share(covered)
    out["base_failed"] = (n_words < 50) | (100 * out["n_repeat_words"] > 50 * n_words)
    good = out["dup_line_chars"] <= LINES
    for name, limits in (("top", TOP), ("dup", DUPLICATE)):
        for n, limit in limits.items():
            good &= out[f"{name}_{n}gram"] <= limit
    out["kept"] = ~out["base_failed"] & good
    return out


LONGS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["dup_line_chars", *(f"top_{n}gram" for n in TOP), *(f"dup_{n}gram" for n in DUPLICATE)]


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, buf, off in blocks(batch, limit=2 << 20):
            m = measure(buf, off)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(i64(m[c]) for c in LONGS), *(pa.array(m[c].astype(np.float64)) for c in SHARES),
                 pa.array(m["base_failed"]), pa.array(m["kept"])], ["doc_id", *LONGS, *SHARES, "base_failed", "kept"])


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts of ``LONGS``, the shares of ``SHARES``, base_failed, kept."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in LONGS) + ", "
                             + ", ".join(f"{c} double" for c in SHARES) + ", base_failed boolean, kept boolean")
