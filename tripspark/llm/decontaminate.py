"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the postings of every training token. The index is dealt by documents: each row is a
segment of some documents with its sorted terms, their posting lists (word positions, ascending) and the
documents' borders. ``search`` sends the benchmark's words (a stated query set, in blocks of bounded size)
to every segment and makes its windows there: a window with an absent term is out; else the postings of its rarest term, moved by
the term's offset, are the candidates, and the other terms' lists are intersected in order of rarity.
``slop`` 0 finds exact phrases; above 0 a term may stand that many words from its place (proximity match).

Nothing is shuffled, a segment is bounded by ``SEGMENT_BYTES`` of text or one document, and each task is a function
of its own rows. Words: A-Z in lower case, runs of ``[0-9a-z]`` and non-ASCII characters.

Null or empty texts have no words: such documents come out with zeros, such items match nowhere. An item
whose id is null marks words but is not counted among the items; items of one id count once. Rows that repeat are
answered row by row. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.llm.common import WORD_BASE, blocks, lut, ranges, small_batches, spans_hash, text_bytes, word_bounds
from tripspark.session import shared_dir

#: Separators of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z went to lower case.
SEPARATORS = lut((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: Most text of a segment (or one document).
SEGMENT_BYTES = 256 << 10
#: Words of the items, and places of their rarest terms, that a task looks up in a segment at once.
QUERY_WORDS, CANDIDATES = 1 << 16, 1 << 18
#: Row groups and pages end with the row that brings them to this size. Without the third, Parquet looks only after 100 rows; hashes don't repeat.
_STORE = {"parquet.block.size": 4 << 20, "parquet.page.size": SEGMENT_BYTES, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": "false"}
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32


def _words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    folded = _FOLD[buf]
    start, end, first = word_bounds(folded, off, SEPARATORS)
    return spans_hash(folded, start, end, WORD_BASE), first


def _packed(values: np.ndarray, most: int = 1 << 64) -> pa.Array:
    """One binary value: the numbers' bytes, 2 or 4 each if none is above ``most``. Spark moves it at once, and an array number by number."""
    values = np.ascontiguousarray(values, "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<u8")
    return pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, values.nbytes], np.int32)), pa.py_buffer(values)])


def _unpacked(value: pa.Scalar, n: int) -> np.ndarray:
    """The ``n`` numbers of a packed value."""
    buf = value.as_buffer()
    return np.frombuffer(buf, f"<u{buf.size // max(n, 1) or 8}")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, buf, off in blocks(batch, limit=SEGMENT_BYTES):
            h, first = _words(buf, off)
            order = np.argsort(h, kind="stable")
            by_term = h[order]
            starts = np.flatnonzero(np.concatenate(([True], by_term[1:] != by_term[:-1]))) if len(h) else np.zeros(0, np.int64)
            ids = part.column("doc_id")
            yield pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 _packed(first, len(h)), _packed(by_term[starts]), _packed(np.append(starts, len(h)), len(h)), _packed(order, len(h))],
                ["segment", "ids", "first", "terms", "lists", "positions"])


def _small_reads(spark: SparkSession) -> None:
    """``small_batches``, and Parquet read by few rows: a reader keeps the texts or the postings of all rows of a step."""
    small_batches(spark).conf.set("spark.sql.parquet.columnarReaderBatchSize", "256")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Segments (segment, ids, first, terms, lists, positions): all postings of all documents.

    The last four are numbers packed in a binary value each: ``terms`` of 8 bytes, the others of 2, or 4 in a segment of more than 65,535 words."""
    _small_reads(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_segments, f"segment string, ids array<{kind}>, first binary, terms binary, lists binary, positions binary")


def stored_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``build_index`` written to ``path`` (small row groups: a segment is a large row) and read back."""
    return _written(build_index(docs, id_col, text_col), path)


def _written(index: DataFrame, path: str) -> DataFrame:
    index.write.options(**_STORE).parquet(path)
    return index.sparkSession.read.parquet(path)


def query_of(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The items' distinct words (hashes, ascending), the number of each word among them, and each item's first word (and the end)."""
    h, first = _words(*text_bytes(pa.array(texts, pa.large_string())))
    distinct, code = np.unique(h, return_inverse=True)
    return distinct, code.astype(np.int32), first


def _places(windows: np.ndarray, lists: np.ndarray, keys: np.ndarray, first: np.ndarray, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(window, first word) of each match in a segment, ``CANDIDATES`` at a time; windows: rows of the segment's terms."""
    words, n = len(keys), windows.shape[1]
    count = (lists[1:] - lists[:-1])[windows]
    rank = np.argsort(count, axis=1, kind="stable")
    row = np.arange(len(windows))
    rare, size = windows[row, rank[:, 0]], count[row, rank[:, 0]]
    total = np.concatenate(([0], np.cumsum(size)))
    a = 0
    while a < len(windows):
        b = max(a + 1, int(np.searchsorted(total, total[a] + CANDIDATES, "right")) - 1)
        which = np.repeat(row[a:b], size[a:b])
        at = ranges(lists[rare[a:b]], size[a:b])
        start = keys[at] - np.repeat(rare[a:b], size[a:b]) * words - np.repeat(rank[a:b, 0], size[a:b])
        a = b
        inside = (start >= 0) & (start + n <= words)
        which, start = which[inside], start[inside]
        doc = np.searchsorted(first, start, "right") - 1
        inside = start + n <= first[doc + 1]
        which, start, doc = which[inside], start[inside], doc[inside]
        for k in range(1, n):  # the other lists, the rarest first
            if not len(which):
                break
            place = start + rank[which, k]
            base = windows[which, rank[which, k]] * words
            low, high = np.maximum(place - slop, first[doc]), np.minimum(place + slop, first[doc + 1] - 1)
            found = np.minimum(np.searchsorted(keys, base + low), words - 1)
            ok = (keys[found] >= base + low) & (keys[found] <= base + high)
            which, start, doc = which[ok], start[ok], doc[ok]
        yield which, start


def find_items(query: tuple, size: int, terms: np.ndarray, lists: np.ndarray, keys: np.ndarray, first: np.ndarray,
               slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, start, end) of each window that matches in a segment; keys: term * words + position, ascending.

    Windows are made of ``QUERY_WORDS`` words of the items (or one item) at a time, and only where no term is absent."""
    distinct, code, items = query
    found = [(np.zeros(0, np.int64),) * 3]
    if len(terms):
        at = np.minimum(np.searchsorted(terms, distinct), len(terms) - 1)
        term = np.where(terms[at] == distinct, at, -1)
        a = 0
        while a < len(items) - 1:
            b = max(a + 1, int(np.searchsorted(items, items[a] + QUERY_WORDS, "right")) - 1)
            words, begin = term[code[items[a]:items[b]]], items[a:b + 1] - items[a]
            absent, length = np.concatenate(([0], np.cumsum(words < 0))), np.diff(begin)
            long = np.minimum(length, size)
            for n in np.unique(long[long > 0]).tolist():
                of = np.flatnonzero(long == n)
                at = ranges(begin[of], length[of] - n + 1)
                at = at[absent[at + n] == absent[at]]
                for w, s in _places(words[at[:, None] + np.arange(n)], lists, keys, first, slop):
                    found.append((a + np.searchsorted(begin, at[w], "right") - 1, s, s + n))
            a = b
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def _search(ids: list, query: tuple, size: int, slop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids = batch.column("ids").slice(i, 1).flatten()
                first = _unpacked(batch.column("first")[i], len(doc_ids) + 1).astype(np.int64)
                terms = np.frombuffer(batch.column("terms")[i].as_buffer(), "<u8")
                lists = _unpacked(batch.column("lists")[i], len(terms) + 1).astype(np.int64)
                positions = _unpacked(batch.column("positions")[i], int(first[-1]))
                keys = np.repeat(np.arange(len(terms)), np.diff(lists)) * len(positions) + positions
                item, start, end = find_items(query, size, terms, lists, keys, first, slop)
                # one run for each item where its windows overlap or touch
                order = np.lexsort((start, item))
                item, start, end = item[order], start[order], end[order]
                doc = np.searchsorted(first, start, "right") - 1
                new = np.ones(len(item), bool)
                new[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] > end[:-1])
                a = np.flatnonzero(new)
                item, start, doc, end = item[a], start[a], doc[a], (np.maximum.reduceat(end, a) if len(a) else end)
                step = np.zeros(len(positions) + 1, np.int64)
                np.add.at(step, start, 1)
                np.add.at(step, end, -1)
                hit = np.concatenate(([0], np.cumsum(np.cumsum(step[:-1]) > 0)))[first]
                order = np.lexsort((item, start, doc))
                item, start, end, doc = item[order], start[order], end[order], doc[order]
                matches = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(doc, np.arange(len(first))), pa.int32()),
                    pa.StructArray.from_arrays([pa.array([ids[x] for x in item], pa.string()), pa.array(start - first[doc], pa.int64()),
                                                pa.array(end - first[doc], pa.int64())], ["item", "start", "end"]))
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("segment")[i].as_py()] * n, pa.string()), pa.array(np.arange(n), pa.int32()), doc_ids,
                     pa.array(np.diff(first)), pa.array(np.diff(hit), pa.int64()), matches],
                    ["segment", "row", "doc_id", "n_words", "n_hit", "matches"])
    return run


def search(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = 10,
           slop: int = 0, block_chars: int = 64_000_000) -> DataFrame:
    """(doc_id, n_words, n_hit, matches): each document's runs of words that match windows of the items.

    ``matches`` are structs (item, start, end) in words. Items are sent in blocks of at most ``block_chars`` characters
    (or one item); with several blocks, each document's runs are merged.
    """
    _small_reads(index.sparkSession)
    kind = index.schema["ids"].dataType.elementType.simpleString()
    schema = f"segment string, row int, doc_id {kind}, n_words long, n_hit long, matches array<struct<item:string,start:long,end:long>>"
    out, ids, texts, chars, written = [], [], [], 0, index

    def flush() -> None:
        out.append(written.mapInArrow(_search(list(ids), query_of(texts), size, slop), schema))
        ids.clear()
        texts.clear()

    # an index that is computed anew for each block would have other segments each time: then it is written first
    computed = not index._jdf.queryExecution().analyzed().children().isEmpty()
    for r in items.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        if texts and chars + len(r.t or "") > block_chars:
            if computed and written is index:
                written = _written(index, f"{shared_dir(index.sparkSession)}/llm/index-{uuid.uuid4().hex}")
            flush()
            chars = 0
        ids.append(r.i)
        texts.append(r.t)
        chars += len(r.t or "")
    flush()
    if len(out) == 1:
        return out[0].drop("segment", "row")
    every = out[0]
    for x in out[1:]:
        every = every.unionByName(x)
    merged = every.groupBy("segment", "row").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
                                                 F.sort_array(F.flatten(F.collect_list("matches"))).alias("matches"))
    places = "size(array_distinct(flatten(transform(matches, x -> sequence(x.start, x.end - 1)))))"
    return merged.select("doc_id", "n_words", F.expr(places).cast("long").alias("n_hit"), "matches")
