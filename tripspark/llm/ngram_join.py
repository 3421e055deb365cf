"""Near-duplicate join on word n-grams (Jaccard) with Bayesian pruning of candidate pairs.

Texts with equal words are one class; classes are joined, copies follow by membership. Each class has a signature of
16-bit MinHash values. Classes that agree in one of the signature's bands are candidates. Two posteriors guard the work:
matching values are counted a step at a time, and a pair is dropped when the probability that its similarity
reaches the threshold, given the matches so far, falls below ``tolerance``. The rest is verified exactly on the sets of n-grams.

Pairs never become rows. Members of a band's bucket (or of a component, for the exact step) are dealt to
pairs of blocks; a task goes through the pairs of its blocks in vectorised steps and returns one row per member:
the links it found, and the least member it is tied to. So a group of g near copies costs g * g / ``most`` rows.

1. signatures of all documents, classes of equal words
2. buckets of (band, values): pairs that agree in no earlier band, pruned; what is left ties members together
3. components of these ties; inside them pruned again, verified exactly, links counted
4. components of the verified links give the class ids

With 32 bands of 4 values, a pair at similarity 0.8 misses every band with probability 5e-8; ``tolerance`` adds 1e-9 a step.

Words are runs of non-white-space, unchanged. A text of fewer than n words is one n-gram. Texts without words (null, empty)
have no links and are classes of their own. Rows that repeat are copies of each other and link. An id of null takes part like
any other; class ids are the least id that is not null. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import SPACE, WORD_BASE, blocks, i64, join_counted, mix, ranges, row_key, small_batches, spans_hash, stored, word_bounds
from tripspark.llm.graph import block_pairs, components, merge, pairs_in_groups, whole_groups

BANDS, ROWS = 32, 4
VALUES = BANDS * ROWS
STEP = 32
_GRAM = 0xE7037ED1A0B428DB


def fewest_matches(threshold: float, tolerance: float, values: int = VALUES, step: int = STEP) -> list[tuple[int, int]]:
    """(n, m): after n values, pairs with fewer than m matches go. Uniform prior on the similarity, 16-bit values."""
    s = (np.arange(40_000) + 0.5) / 40_000
    p = s + (1 - s) / 65536
    out = []
    for n in range(step, values + 1, step):
        least = 0
        for m in range(n + 1):
            log = m * np.log(p) + (n - m) * np.log1p(-np.minimum(p, 1 - 1e-12))
            w = np.exp(log - log.max())
            if w[s >= threshold].sum() / w.sum() >= tolerance:
                break
            least = m + 1
        out.append((n, least))
    return out


def text_keys(buf: np.ndarray, off: np.ndarray) -> pa.Array:
    """128 bits of each text's words, joined by one space; null without words."""
    start, _, first = word_bounds(buf, off, SPACE)
    kept = ~SPACE[buf]
    inner = np.ones(len(start), bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    kept[start[inner] - 1] = True
    words = np.where(SPACE[buf], np.uint8(0x20), buf)[kept].tobytes()
    at = np.concatenate(([0], np.cumsum(kept)))[off].tolist()
    return pa.array([hashlib.blake2b(words[a:b], digest_size=16).digest() if b > a else None for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())


def _grams(buf: np.ndarray, off: np.ndarray, n: int):
    """n-gram hashes of a block and each text's first n-gram (and the end)."""
    start, end, first = word_bounds(buf, off, SPACE)
    h = spans_hash(buf, start, end, WORD_BASE)
    words = np.diff(first)
    count = np.where(words > 0, np.maximum(words - n + 1, 1), 0)
    at = ranges(first[:-1], count)
    stop = np.minimum(at + n, np.repeat(first[1:], count))
    return spans_hash(h, at, stop, _GRAM), np.concatenate(([0], np.cumsum(count)))


def _multipliers() -> np.ndarray:
    return mix(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signatures(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values (texts x VALUES, 16 bits); every text must have an n-gram."""
    out = np.empty((len(first) - 1, VALUES), np.uint16)
    if len(out):
        for k, a in enumerate(_multipliers()):
            out[:, k] = (mix(np.minimum.reduceat(grams * a, first[:-1])) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def _fixed(rows: np.ndarray) -> pa.Array:
    """A binary column from the rows of a matrix."""
    width = rows.shape[1] * rows.itemsize
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * width),
                                                                pa.py_buffer(np.ascontiguousarray(rows))])


def _matrix(column: pa.Array) -> np.ndarray:
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]].view(np.uint16).reshape(len(column), VALUES)


def _sign(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in blocks(batch, limit=1 << 20):
                grams, first = _grams(buf, off, n)
                none = first[1:] == first[:-1]
                some = np.flatnonzero(~none)
                sig = _fixed(signatures(grams, np.append(first[:-1][some], len(grams))))
                place = np.zeros(len(none), np.int64)
                place[some] = np.arange(len(some))
                yield pa.RecordBatch.from_arrays(
                    [part.column("rid"), part.column("doc_id"), text_keys(buf, off), sig.take(pa.array(place, mask=none))], ["rid", "doc_id", "key", "sig"])
    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each band of each class: a hash of band and values."""
    for batch in batches:
        bands = np.ascontiguousarray(_matrix(batch.column("sig"))).view(np.uint64)
        salt = mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(77))
        yield pa.RecordBatch.from_arrays([i64(mix(bands ^ salt).ravel()), pa.array(np.repeat(batch.column("u").to_numpy(), BANDS)),
                                          pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(bands)))], ["bucket", "u", "band"])


def prune(sig: np.ndarray, a: np.ndarray, b: np.ndarray, least: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that pass every step of the posterior test."""
    matches, done = np.zeros(len(a), np.int64), 0
    for n, m in least:
        matches += (sig[a, done:n] == sig[b, done:n]).sum(axis=1)
        keep = matches >= m
        a, b, matches, done = a[keep], b[keep], matches[keep], n
    return a, b


def _order(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "lo", "hi"))


def _tie(least: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, start in whole_groups(batches, ["bucket", "lo", "hi"]):
            sig = _matrix(batch.column("sig"))
            bands = np.ascontiguousarray(sig).view(np.uint64)
            band, u = batch.column("band").to_numpy(), batch.column("u").to_numpy()
            label = np.arange(len(u))
            for a, b in pairs_in_groups(start, len(u), *_order(batch)):
                new = (bands[a] == bands[b]).argmax(axis=1) == band[a]
                label = merge(label, *prune(sig, a[new], b[new], least))
            tied = np.flatnonzero(label != np.arange(len(u)))
            yield pa.RecordBatch.from_arrays([pa.array(u[tied]), pa.array(u[label[tied]])], ["a", "b"])
    return run


def _verify(n: int, threshold: float, least: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, start in whole_groups(batches, ["root", "lo", "hi"]):
            sig, u, copies = _matrix(batch.column("sig")), batch.column("u").to_numpy(), batch.column("copies").to_numpy()
            grams, sizes = [], []
            for _, buf, off in blocks(batch.select(["text"])):
                g, first = _grams(buf, off, n)
                doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
                order = np.lexsort((g, doc))
                g, doc = g[order], doc[order]
                one = np.ones(len(g), bool)
                one[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
                grams.append(g[one])
                sizes.append(np.bincount(doc[one], minlength=len(off) - 1))
            size = np.concatenate(sizes)
            distinct, gram = np.unique(np.concatenate(grams), return_inverse=True)
            at = np.concatenate(([0], np.cumsum(size)))
            mark = np.zeros(len(distinct), bool)
            label, links, texts = np.arange(len(u)), np.zeros(len(u), np.int64), np.zeros(len(u), np.int64)
            for a, b in pairs_in_groups(start, len(u), *_order(batch)):
                different = u[a] != u[b]
                a, b = prune(sig, a[different], b[different], least)
                near = np.zeros(len(a), bool)
                for one in np.unique(a):  # a is ascending: each text's partners stand together
                    lo, hi = np.searchsorted(a, [one, one + 1])
                    mine, partners = gram[at[one]:at[one + 1]], b[lo:hi]
                    mark[mine] = True
                    both = np.add.reduceat(mark[gram[ranges(at[partners], size[partners])]].astype(np.int64),
                                           np.concatenate(([0], np.cumsum(size[partners])[:-1])))
                    mark[mine] = False
                    near[lo:hi] = both >= threshold * (size[one] + size[partners] - both) - 1e-9
                a, b = a[near], b[near]
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                np.add.at(texts, a, 1)
                np.add.at(texts, b, 1)
                label = merge(label, a, b)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(u[label]), pa.array(links), pa.array(texts)], ["a", "b", "links", "texts"])
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8,
                    tolerance: float = 1e-9, most: int = 512) -> DataFrame:
    """(rid, root, doc_id, class_id, text_id, n_links, n_text_links), a row for each document.

    ``class_id``: least id among the documents tied by links; ``text_id``: least id among those with equal words;
    ``n_links``: other documents at ``threshold`` or more; ``n_text_links``: different texts among them. ``rid`` is ``row_key``'s,
    ``root`` a number of the class in this result (null without words). Texts of equal words are told by 128 bits and numbered when they are
    stored, so no two of them share a number.
    """
    spark = small_batches(docs.sparkSession)
    source = row_key(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    least = fewest_matches(threshold, tolerance)
    signed = stored(spark, source.mapInArrow(_sign(n), f"rid binary, doc_id {kind}, key binary, sig binary"), "signatures")
    classes = stored(spark, signed.filter("key is not null").groupBy("key").agg(
        F.count("*").alias("copies"), F.min("rid").alias("rid"), F.min("doc_id").alias("text_id"), F.min("sig").alias("sig"))
        .withColumn("u", F.monotonically_increasing_id()), "classes")

    bands = classes.select("u", "sig").mapInArrow(_buckets, "bucket long, u long, band int")
    shared = stored(spark, bands.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1"), "buckets")
    members = join_counted(bands, shared, "bucket", "members", "u").join(classes.select("u", "sig"), "u")
    dealt = block_pairs(members, "bucket", "members", "u", most).repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi", "block")
    ties = dealt.select("bucket", "lo", "hi", "block", "band", "u", "sig").mapInArrow(_tie(least), "a long, b long")
    near = components(spark, ties, "ties")
    near = near.unionByName(near.select(F.col("root").alias("u"), "root").distinct())
    sizes = stored(spark, near.groupBy("root").agg(F.count("*").alias("members")), "sizes")
    placed = join_counted(near, sizes, "root", "members", "u").join(classes.select("u", "rid", "copies", "sig"), "u")
    texts = source.select("rid", "text").join(placed, "rid").dropDuplicates(["u"])
    dealt = block_pairs(texts, "root", "members", "u", most).repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi", "block")
    verified = stored(spark, dealt.select("root", "lo", "hi", "block", "u", "copies", "sig", "text")
                      .mapInArrow(_verify(n, threshold, least), "a long, b long, links long, texts long"), "verified")
    counts = verified.groupBy(F.col("a").alias("u")).agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    root = components(spark, verified.select("a", "b"), "links")
    one = (classes.select("u", "key", "copies", "text_id").join(counts, "u", "left").join(root, "u", "left")
           .withColumn("root", F.coalesce("root", "u")))
    ids = one.groupBy("root").agg(F.min("text_id").alias("class_id"), F.count("*").alias("members"))
    result = stored(spark, join_counted(one, ids, "root", "members", "u").select(
        "key", "root", "copies", "class_id", "text_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("texts", F.lit(0)).cast("long").alias("n_text_links")), "classes")
    with_words = join_counted(signed.select("rid", "doc_id", "key").filter("key is not null"), result, "key", "copies", "xxhash64(rid)")
    return with_words.select("rid", "root", "doc_id", "class_id", "text_id", "n_links", "n_text_links").unionByName(
        signed.filter("key is null").select("rid", F.lit(None).cast("long").alias("root"), "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("text_id"),
                                          F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_text_links")))
