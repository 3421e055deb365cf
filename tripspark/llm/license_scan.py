"""License scans: winnowed fingerprints in an inverted index pick candidates, banded alignment reports coverage and spans.

Templates and texts are words (A-Z in lower case, runs of letters and digits). The hashes of ``k`` consecutive words are winnowed:
of every ``window`` neighbours the least is kept, so a shared run of ``k + window - 1`` words always shares a
fingerprint. The templates' fingerprints form an inverted index (fingerprint, template, position), a stated query set sent
to every task. A text's fingerprints are looked up; hits of one template that agree on where it would start, give or take
``band`` words (or half the template, if that is less), are one candidate. Each candidate is aligned word by word in a band around that start (match 2, mismatch and
gap -1, best local score); unless all words match in a row, the band is doubled until it holds every shift that the reporting rule allows
(``len * (1 / coverage - 1)`` words), so words put in or left out in one place don't part a notice. A candidate whose words in reach can't make up the coverage isn't aligned. Reported are alignments that match at least ``coverage`` of the template's words and as large a part of their own
columns; of overlapping ones the highest score stands (then the longer, the earlier template).

Close relatives are told apart by the words that set a template off: where a template matches another license's template so well that it
would be reported there, its words without a partner, and its neighbouring words between which the other one has more, are its marks. An alignment
that keeps less than ``coverage`` of the marks against any relative, or that has a number of the template against another word (beyond its
ends: another number below ``VERSIONS``), is not reported, whatever it matches else: an unknown version or kin of a license is not given a relative's name.

Each text is scanned whole in its own task, nothing is shuffled. Null, empty and blank texts match nothing. Rows that repeat are scanned
each; templates of fewer than ``k`` words have no fingerprint and are never found.
Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.llm.common import WORD_BASE, blocks, i64, lut, ranges, small_batches, spans_hash, text_bytes, windows_hash, word_bounds
from tripspark.llm.license_templates import TEMPLATES

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_SEPARATORS = lut((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
_GRAM = 0xAF251AF3B0F025B5
#: Most words of all templates that are sent to every task.
MOST_WORDS = 5_000_000
#: Rows of an alignment whose moves are held at once; those of earlier rows are computed again from the scores between.
STRIP = 1024
#: Numbers below this one can be part of a version.
VERSIONS = 100


def _words(buf: np.ndarray, off: np.ndarray):
    folded = _FOLD[buf]
    start, end, first = word_bounds(folded, off, _SEPARATORS)
    return start, end, first, spans_hash(folded, start, end, WORD_BASE)


def winnow(h: np.ndarray, first: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, fingerprint): in every run of ``window`` k-grams of a text the least, the last of equals; all of a shorter text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    grams = windows_hash(h, k, _GRAM)
    at = np.flatnonzero(text[:len(grams)] == text[k - 1:]) if len(grams) else np.zeros(0, np.int64)
    count = np.bincount(text[at], minlength=len(first) - 1)  # k-grams of each text
    begin = np.concatenate(([0], np.cumsum(count)))
    values, owner = grams[at], text[at]
    size = np.minimum(window, count[owner]) if len(at) else at
    best = np.arange(len(at))
    for d in range(1, window):
        other = np.minimum(np.arange(len(at)) + d, len(at) - 1)
        take = (d < size) & (owner[other] == owner) & (values[other] <= values[best])
        best = np.where(take, other, best)
    full = np.arange(len(at)) + size <= begin[owner + 1] if len(at) else np.zeros(0, bool)
    chosen = np.unique(best[full])
    return at[chosen], values[chosen]


@dataclass
class Index:
    """Templates' words, their fingerprints in ascending order with template and position, the positions of numbers, the hashes of numbers
    that a version may have, and each template's marks against its relatives: positions of words, and of words that the next one must follow directly."""

    names: list[str]
    words: list[np.ndarray]
    prints: np.ndarray
    template: np.ndarray
    position: np.ndarray
    k: int
    window: int
    numbers: list[np.ndarray]
    versions: np.ndarray
    marks: list[list[tuple[np.ndarray, np.ndarray]]]


def build_index(templates: list[tuple[str, str]], k: int = 3, window: int = 3, coverage: float = 0.8) -> Index:
    templates = [(str(n), t) for n, t in templates if t]
    buf, off = text_bytes(pa.array([t for _, t in templates], pa.large_string()))
    start, end, first, h = _words(buf, off)
    if len(h) > MOST_WORDS:
        raise ValueError(f"templates have {len(h)} words; send at most {MOST_WORDS} at a time")
    words = [h[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
    at, prints = winnow(h, first, k, window)
    owner = np.searchsorted(first, at, "right") - 1
    order = np.lexsort((at, owner, prints))
    digits = np.concatenate(([0], np.cumsum((buf >= 0x30) & (buf <= 0x39))))
    number = digits[end] - digits[start] == end - start
    index = Index([n for n, _ in templates], words, prints[order], owner[order], (at - first[owner])[order], k, window,
                  [np.flatnonzero(number[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)],
                  _words(*text_bytes(pa.array([" ".join(map(str, range(VERSIONS)))])))[3], [])
    index.marks = _marks(index, coverage)
    return index


def _marks(index: Index, coverage: float) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """Each template's marks against the templates of other names in which it would be reported."""
    out: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in index.words]
    counts = [np.unique(w, return_counts=True) for w in index.words]
    prints = [np.sort(index.prints[index.template == t]) for t in range(len(index.words))]
    for t, words in enumerate(index.words):
        partner = np.empty(len(words), np.int64)
        for u, other in enumerate(index.words):
            if index.names[u] == index.names[t] or not np.isin(prints[t], prints[u]).any() or not _enough(*counts[t], other, coverage * len(words)):
                continue
            _, same, columns, _, _ = align(words, other, 0, max(len(words), len(other)), partner)
            if same >= coverage * len(words) and same >= coverage * columns:
                alone, parted = np.flatnonzero(partner < 0), _parted(partner)
                if len(alone) + len(parted):
                    out[t].append((alone, parted))
    return out


def _parted(partner: np.ndarray) -> np.ndarray:
    """Positions whose word and the next one match, but not side by side."""
    return np.flatnonzero((partner[:-1] >= 0) & (partner[1:] >= 0) & (partner[1:] != partner[:-1] + 1))


def named_right(index: Index, t: int, partner: np.ndarray, text: np.ndarray, coverage: float) -> bool:
    """Whether an alignment (``partner``: the text's word that each word matches; -1: none, -2: another word) keeps the template's marks."""
    numbers = index.numbers[t]
    if (partner[numbers] == -2).any():
        return False
    matched = np.flatnonzero(partner >= 0)
    if len(matched) and len(numbers):  # numbers beyond the ends of the alignment: another number may stand in their place
        first, last = int(matched[0]), int(matched[-1])
        place = np.concatenate((numbers[numbers < first] - first + partner[first], numbers[numbers > last] - last + partner[last]))
        if np.isin(text[place[(place >= 0) & (place < len(text))]], index.versions).any():
            return False
    beside = np.zeros(len(partner), bool)
    beside[:-1] = (partner[:-1] >= 0) & (partner[1:] == partner[:-1] + 1)
    return all((partner[alone] >= 0).sum() + beside[parted].sum() >= coverage * (len(alone) + len(parted)) for alone, parted in index.marks[t])


def _fill(template: np.ndarray, text: np.ndarray, offset: int, band: int, score: np.ndarray, move: np.ndarray, rows: range) -> tuple[int, int, int]:
    """Compute ``rows`` (from 1) of an alignment: ``score`` is the row before and becomes the last one, ``move`` takes their moves.
    Returns the best score and where it is first reached."""
    best, row_of, column = 0, 0, 0
    steps = np.arange(2 * band + 1)
    for i in rows:
        j = i - 1 + offset + steps - band  # text word that column c compares
        inside = (j >= 0) & (j < len(text))
        equal = inside & (text[np.clip(j, 0, max(len(text) - 1, 0))] == template[i - 1]) if len(text) else inside
        slant = score[1:-1] + np.where(equal, 2, -1)
        up = score[2:] - 1  # a template word without a partner
        row = np.where(inside, np.maximum(np.maximum(slant, up), 0), 0)
        # gaps in the template: a running maximum from the left, one point off a step
        across = np.maximum.accumulate(row + steps) - steps
        row = np.where(inside, np.maximum(row, across), 0)
        move[i - rows.start, 1:-1] = np.where(row <= 0, 0, np.where(row == slant, 1, np.where(row == up, 2, 3)))
        score[1:-1] = row
        c = int(row.argmax())
        if row[c] > best:
            best, row_of, column = int(row[c]), i, c + 1
    return best, row_of, column


def align(template: np.ndarray, text: np.ndarray, offset: int, band: int, partner: np.ndarray | None = None) -> tuple[int, int, int, int, int]:
    """Best local alignment of a template with text near template position 0 = text position ``offset``.

    Returns score, matches, columns, start and end in the text (0s if nothing matches). Cells are (i, j) with
    j - i - offset within ``band``; ties keep the earliest end, and a match before a gap. ``partner``, if given, takes the text's word
    that each template word equals (-1: none, -2: it stands against another word). Moves are held for a strip of rows only, and the
    scores between strips, so memory grows with the band times the square root of a long template.
    """
    n, width, height = len(template), 2 * band + 3, max(STRIP, int(len(template) ** 0.5))
    score, move = np.zeros(width, np.int32), np.zeros((min(n, height), width), np.int8)
    saved, best, i, c, held = [], 0, 0, 0, -1
    for held, top in enumerate(range(1, n + 1, height)):
        saved.append(score.copy())
        found, row, column = _fill(template, text, offset, band, score, move, range(top, min(n + 1, top + height)))
        if found > best:
            best, i, c = found, row, column
    if partner is not None:
        partner[:] = -1
    matches = columns = 0
    end = i + offset + c - 1 - band if best else 0
    start = end
    while best and i:
        strip = (i - 1) // height
        if strip != held:
            held, top = strip, strip * height + 1
            _fill(template, text, offset, band, saved[strip].copy(), move, range(top, min(n + 1, top + height)))
        kind = move[i - 1 - held * height, c]
        if not kind:
            break
        columns += 1
        if kind == 1:
            start = i - 1 + offset + c - 1 - band
            same = text[start] == template[i - 1]
            matches += int(same)
            if partner is not None:
                partner[i - 1] = start if same else -2
            i -= 1
        elif kind == 2:
            i, c = i - 1, c + 1
        else:
            c -= 1
    return best, matches, columns, start, end


def _enough(known: np.ndarray, times: np.ndarray, text: np.ndarray, need: float) -> bool:
    """Whether a text shares ``need`` words with a template, each word as often as both have it."""
    if len(text) < need:
        return False
    at = np.minimum(np.searchsorted(known, text), len(known) - 1)
    have = np.bincount(at[known[at] == text], minlength=len(known))
    return int(np.minimum(have, times).sum()) >= need


def _bands(near: int, full: int) -> list[int]:
    """Half-widths to try: ``near``, doubled up to ``full``."""
    out = [near]
    while out[-1] < full:
        out.append(min(max(2 * out[-1], 1), full))
    return out


def matches_of(index: Index, h: np.ndarray, at: np.ndarray, prints: np.ndarray, coverage: float, band: int) -> list[tuple]:
    """Reported alignments of one text: (license, template, start, end, matched, coverage), by start."""
    lo, hi = np.searchsorted(index.prints, prints), np.searchsorted(index.prints, prints, "right")
    hit = ranges(lo, hi - lo)
    if not len(hit):
        return []
    template, start = index.template[hit], np.repeat(at, hi - lo) - index.position[hit]
    order = np.lexsort((start, template))
    template, start = template[order], start[order]
    found = []
    group = 0
    counts: dict[int, tuple] = {}  # each template's distinct words and how often it has them
    for x in range(1, len(start) + 1):
        words = index.words[template[group]]
        near = min(band, len(words) // 2)  # copies of a short template may follow one another
        if x == len(start) or template[x] != template[group] or start[x] - start[group] > near:
            t = int(template[group])
            middle = int(np.median(start[group:x]))
            reach = int(len(words) * (1 / coverage - 1)) if coverage > 0 else len(h)
            full = max(near, min(len(h), reach + max(middle - int(start[group]), int(start[x - 1]) - middle)))
            if t not in counts:
                counts[t] = np.unique(words, return_counts=True)
            for wide in _bands(near, full) if _enough(*counts[t], h[max(0, middle - full):max(0, middle + len(words) + full)], coverage * len(words)) else []:
                frm = max(0, middle - wide)
                partner = np.empty(len(words), np.int64)
                near_text = h[frm:max(frm, middle + len(words) + wide)]
                score, same, columns, a, b = align(words, near_text, middle - frm, wide, partner)
                if same >= coverage * len(words) and same >= coverage * columns and named_right(index, t, partner, near_text, coverage):
                    found.append((-score, -len(words), t, a + frm, b + frm, same))
                if same == columns == len(words):
                    break
            group = x
    out: list[tuple] = []
    starts, ends = [], []  # spans taken so far; they don't overlap, so both ascend
    for _, size, t, a, b, same in sorted(found):
        k = bisect_right(starts, a)
        if (k == 0 or ends[k - 1] <= a) and (k == len(starts) or starts[k] >= b):
            starts.insert(k, a)
            ends.insert(k, b)
            out.append((index.names[t], t, a, b, same, same / -size))
    return sorted(out, key=lambda o: (o[2], o[1]))


def _scan(index: Index, coverage: float, band: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in blocks(batch):
                start, end, first, h = _words(buf, off)
                lead = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
                at, prints = winnow(h, first, index.k, index.window)
                text = np.searchsorted(first, at, "right") - 1
                known = np.isin(prints, index.prints)
                rows: list[list] = [[] for _ in range(part.num_rows)]
                for d in np.unique(text[known]):
                    mine = known & (text == d)
                    a, b = first[d], first[d + 1]
                    for name, _, s, e, same, share in matches_of(index, h[a:b], at[mine] - a, prints[mine], coverage, band):
                        zero = lead[off[d]]
                        rows[d].append({"license": name, "start": int(s), "end": int(e), "char_start": int(lead[start[a + s]] - zero),
                                        "char_end": int(lead[end[a + e - 1]] - zero), "matched": int(same), "coverage": float(share)})
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), i64(np.diff(first)), pa.array(rows, _MATCHES)], ["doc_id", "n_words", "matches"])
    return run


_MATCHES = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("char_start", pa.int64()),
                               ("char_end", pa.int64()), ("matched", pa.int64()), ("coverage", pa.float64())]))


def read_templates(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """(name, text) of each file of a folder of whole license texts; more than ``MOST_WORDS`` words' worth of bytes are refused."""
    files = spark.read.text(folder, wholetext=True).select(F.regexp_extract("_metadata.file_path", r"([^/]+?)(\.txt)?$", 1).alias("name"), "value")
    size = files.agg(F.sum(F.length("value"))).first()[0] or 0
    if size > 20 * MOST_WORDS:
        raise ValueError(f"the licenses in {folder} have {size} characters; send at most {20 * MOST_WORDS} at a time")
    return sorted((r.name, r.value) for r in files.collect())


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text", coverage: float = 0.8,
         band: int = 8, k: int = 3, window: int = 3) -> DataFrame:
    """(doc_id, n_words, matches): each text's licenses with spans in words and in code points, matched words and coverage.

    ``templates``: pairs of license and text (``TEMPLATES`` by default; ``read_templates`` for a folder of whole licenses), of ``MOST_WORDS`` words at most.
    """
    index = build_index(TEMPLATES if templates is None else templates, k, window, coverage)
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_scan(index, coverage, band), f"doc_id {kind}, n_words long, matches array<struct<license:string,start:long,end:long,"
                                                           "char_start:long,char_end:long,matched:long,coverage:double>>")
