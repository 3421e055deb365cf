"""Language identification with language-bitmask Bloom filters of character n-grams.

Learning: tasks count the n-grams of their texts by language, Spark sums the counts. An n-gram is a member of a language if it
makes up at least ``min_share`` of the language's n-grams and at least ``near_best`` of its share in the language where it is
most frequent. (So a language has at most 1/``min_share`` members of each length, which bounds what reaches the driver.)
The members go into one bit-sliced Bloom filter: each slot holds a bit for every language, and the
AND of an n-gram's slots has the bits of all languages that have it as a member, at once.

Deciding: each n-gram of a text is looked up and the bits are counted by language. With a share f of a language's bits set, an
n-gram that is no member still passes with probability f**hashes; the counts are corrected for that. The language with the
highest corrected count wins; the score is its part of the sum over all languages.

N-grams are of lower-case letters, with the border of a word as a character. ``und`` and 0 stand for null, empty and letterless
texts, and for every text if nothing was learned. Ties go to the language with more training n-grams, then to the first by
name. Rows that repeat count each; rows without text or language teach nothing; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import blocks, mix, small_batches

LENGTHS = (3, 4)
HASHES = 3
_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_LOWER: list[np.ndarray] = []


def _lower() -> np.ndarray:
    """By code point: the lower-case letter in 16 bits, 0 for what is no letter. (Planes above 0 fold onto 16 bits.)"""
    if not _LOWER:
        table = np.zeros(0x110000, np.uint16)
        for c in range(0x41, 0x32000):
            if chr(c).isalpha():
                table[c] = (ord(chr(c).lower()[0]) & 0xFFFF) or 1
        _LOWER.append(table)
    return _LOWER[0]


def grams(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the n-grams of a block (all lengths), the text of each, and each text's number of letters."""
    texts = len(off) - 1
    point = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))[off]
    # every text gets a border in front and behind
    size = np.diff(starts)
    place = np.arange(len(point)) + 2 * np.repeat(np.arange(texts), size) + 1
    c = np.zeros(len(point) + 2 * texts, np.uint64)
    c[place] = _lower()[point]
    text = np.repeat(np.arange(texts), size + 2)
    letters = np.bincount(text[c > 0], minlength=texts)
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] > 0) | (c[:-1] > 0) | (text[1:] != text[:-1])  # one border for any run of non-letters
    c, text = c[keep], text[keep]
    keys, owner = [], []
    for n in LENGTHS:
        m = len(c) - n + 1
        if m <= 0:
            continue
        packed, fine = np.zeros(m, np.uint64), text[:m] == text[n - 1:]
        for k in range(n):
            packed = (packed << np.uint64(16)) | c[k:k + m]
            if 0 < k < n - 1:
                fine &= c[k:k + m] > 0
        keys.append(mix(packed[fine] ^ np.uint64(n * 0x1000193)))
        owner.append(text[:m][fine])
    none = np.zeros(0, np.int64)
    return (np.concatenate(keys) if keys else none.astype(np.uint64)), (np.concatenate(owner) if owner else none), letters


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of this task's texts; flushed when many n-grams are held."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, parts in sorted(held.items()):
            k, n = _summed(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        for part, buf, off in blocks(batch, limit=1 << 20):
            key, owner, _ = grams(buf, off)
            names = np.array(part.column("lang").to_pylist(), object)
            for lang in sorted(set(names)):
                mine = key[(names == lang)[owner]]
                held.setdefault(lang, []).append(np.unique(mine, return_counts=True))
                if len(held[lang]) > 15:
                    held[lang] = [_summed(held[lang])]
            if sum(len(p[0]) for parts in held.values() for p in parts) > 8_000_000:
                yield from flush()
    yield from flush()


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return key, np.bincount(back, np.concatenate([p[1] for p in parts]), len(key)).astype(np.int64)


@dataclass
class Filters:
    """``bits``: planes of slots (a plane holds up to 64 languages); ``passing``: chance that a foreign n-gram passes."""

    langs: list[str]
    bits: list[np.ndarray]
    passing: np.ndarray
    slots: int


def _slots(key: np.ndarray, slots: int) -> list[np.ndarray]:
    return [(mix(key ^ s) & np.uint64(slots - 1)).astype(np.int64) for s in _SALTS[:HASHES]]


def make_filters(langs: list[str], members: list[tuple[np.ndarray, np.ndarray]], slots: int) -> Filters:
    """``members``: by language its n-gram keys; ``slots`` is a power of two."""
    planes = []
    for at in range(0, max(len(langs), 1), 64):
        count = min(64, len(langs) - at)
        kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if np.dtype(t).itemsize * 8 >= count)
        plane = np.zeros(slots, kind)
        for bit in range(count):
            for s in _slots(members[at + bit], slots):
                plane[s] |= kind(1 << bit)
        planes.append(plane)
    fill = np.array([np.mean((planes[i // 64] >> planes[i // 64].dtype.type(i % 64)) & 1) for i in range(len(langs))])
    return Filters(langs, planes, fill ** HASHES, slots)


def count_bits(key: np.ndarray, owner: np.ndarray, texts: int, filters: Filters) -> np.ndarray:
    """texts x languages: n-grams whose slots all have the language's bit."""
    slots = _slots(key, filters.slots)
    out = np.zeros((texts, len(filters.langs)), np.int64)
    for p, plane in enumerate(filters.bits):
        mask = plane[slots[0]]
        for s in slots[1:]:
            mask &= plane[s]
        here = min(64, len(filters.langs) - 64 * p)
        if here <= 8:
            table = np.bincount(owner * 256 + mask, minlength=texts * 256).reshape(texts, 256)
            out[:, 64 * p:64 * p + here] = table @ ((np.arange(256)[:, None] >> np.arange(here)) & 1)
        else:
            for b in range(here):
                out[:, 64 * p + b] = np.bincount(owner[(mask >> mask.dtype.type(b)) & mask.dtype.type(1) > 0], minlength=texts)
    return out


def decide(count: np.ndarray, total: np.ndarray, filters: Filters) -> tuple[np.ndarray, np.ndarray]:
    """Winner (place in langs; they stand in order of preference) and score, from counts corrected for false positives."""
    true = np.maximum((count - total[:, None] * filters.passing) / np.maximum(1 - filters.passing, 1e-9), 0)
    best = true.argmax(axis=1)
    return best, true[np.arange(len(true)), best] / np.maximum(true.sum(axis=1), 1e-9)


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_share: float = 2e-6, near_best: float = 0.25,
          slots: int = 1 << 21) -> Filters:
    """Learn from all rows of ``docs`` with a text and a language."""
    small_batches(docs.sparkSession)
    counts = (docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text is not null")
              .mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).persist())
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals, key=lambda x: (-totals[x], x))
    if not langs:
        counts.unpersist()
        return Filters([], [], np.zeros(0), slots)
    size = docs.sparkSession.createDataFrame([(x, totals[x]) for x in langs], "lang string, total long")
    shares = counts.join(F.broadcast(size), "lang").withColumn("share", F.col("n") / F.col("total"))
    best = shares.groupBy("gram").agg(F.max("share").alias("best"), F.collect_list(F.struct("lang", "share")).alias("each"))
    found = (best.filter(F.col("best") >= min_share).select("gram", F.explode("each").alias("e"), "best")
             .filter((F.col("e.share") >= min_share) & (F.col("e.share") >= near_best * F.col("best")))
             .groupBy(F.col("e.lang").alias("lang")).agg(F.collect_list("gram").alias("grams")))
    members = {r.lang: np.array(r.grams, np.int64).view(np.uint64) for r in found.collect()}
    counts.unpersist()
    return make_filters(langs, [members.get(x, np.zeros(0, np.uint64)) for x in langs], slots)


def _predict(filters: Filters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in blocks(batch, limit=1 << 20):
                key, owner, letters = grams(buf, off)
                texts = len(letters)
                if filters.langs:
                    best, score = decide(count_bits(key, owner, texts, filters), np.bincount(owner, minlength=texts), filters)
                    names = np.array(filters.langs, object)[best]
                    names[letters == 0] = "und"
                    score = np.where(letters > 0, score, 0.0)
                else:
                    names, score = np.full(texts, "und", object), np.zeros(texts)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every text."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_predict(filters), f"doc_id {kind}, lang_pred string, score double")
