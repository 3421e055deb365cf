"""Removal of long repeated passages by a compacted de Bruijn graph of word k-mers.

The k-mers (``span`` consecutive words) are the edges of the graph. Those that follow one another
and share their minimizer (the ``k`` words with the least hash among them) form one path, kept as
one row: minimizer, hash of the path's words, document. Documents' paths meet in Spark joins on the minimizer:

* a minimizer seen once: no edge of its path repeats;
* seen again, always with the same path: the path doesn't branch there, all its edges repeat;
* seen with several paths: it branches. Only these paths are spread into their single edges, one
  path of each content, and the edges are counted by content.

Equal windows have equal minimizers, so nothing is missed. Paths and edges go back to their
documents, where the source coordinates give the repeated spans. Counts and joins are by minimizer and path, or minimizer and edge, so chance can only match paths or edges that share their minimizer
(64 bits each); what goes back to a document is a 64-bit hash that is looked up among its own paths or edges. Words are not compared.
This grouping by minimizer stands in for joins of nonbranching neighbours.

Null text has no words; a text of fewer than ``span`` words keeps all; empty tables give empty results.
Rows that repeat (same id, same text) are texts that repeat each other. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import (SPACE, WORD_BASE, blocks, i64, join_counted, list_lengths, mix, ranges, row_key,
                                  sliding_argmin, small_batches, spans_hash, stored, windows_hash, word_bounds)

_MIN, _PATH, _EDGE = 0xA24BAED4963EE407, 0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93


def _paths(buf: np.ndarray, off: np.ndarray, span: int, k: int):
    """Words of a block, and its paths: minimizer, hash, first and last edge, text."""
    start, end, first = word_bounds(buf, off, SPACE)
    h = spans_hash(buf, start, end, WORD_BASE)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    edge = np.flatnonzero(doc[:max(0, len(h) - span + 1)] == doc[span - 1:]) if len(h) >= span else np.zeros(0, np.int64)
    if not len(edge):
        none = np.zeros(0, np.int64)
        return start, end, first, h, (none.astype(np.uint64), none.astype(np.uint64), none, none, none)
    kmer = windows_hash(h, k, _MIN)
    at = sliding_argmin(kmer, span - k + 1)[edge]
    new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    s0, s1 = edge[new], edge[np.concatenate((new[1:], [len(edge)])) - 1]
    return start, end, first, h, (kmer[at[new]], spans_hash(h, s0, s1 + span, _PATH), s0, s1, doc[s0])


def _edges(h: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    return spans_hash(h, at, at + span, _EDGE)


def _within(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    return mix(value ^ mix(doc.astype(np.uint64) + np.uint64(1)))


def _wanted(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lengths, flat = list_lengths(column)
    return np.repeat(np.arange(len(lengths)), lengths), flat.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _path_rows(span: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in blocks(batch):
                *_, (m, path, _, _, doc) = _paths(buf, off, span, k)
                _, one, count = np.unique(_within(doc, path), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([i64(m[one]), i64(path[one]), part.column("rid").take(pa.array(doc[one])), i64(count)],
                                                 ["m", "path", "rid", "n"])
    return run


def _edge_rows(span: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in blocks(batch):
                _, _, _, h, (m, path, s0, s1, doc) = _paths(buf, off, span, k)
                many, single = _wanted(part.column("paths")), _wanted(part.column("solo"))
                mine = _within(doc, path)
                solo = np.isin(mine, _within(*single))
                _, one = np.unique(mine, return_index=True)
                take = np.zeros(len(mine), bool)
                take[one] = True
                take &= solo | np.isin(mine, _within(*many))
                n = (s1 - s0 + 1)[take]
                at = ranges(s0[take], n)
                yield pa.RecordBatch.from_arrays(
                    [i64(np.repeat(m[take], n)), i64(_edges(h, at, span)), part.column("rid").take(pa.array(np.repeat(doc[take], n))),
                     pa.array(np.repeat(solo[take], n))], ["m", "edge", "rid", "solo"])
    return run


def _cut(span: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in blocks(batch):
                start, end, first, h, (_, path, s0, s1, doc) = _paths(buf, off, span, k)
                mine = _within(doc, path)
                _, back, times = np.unique(mine, return_inverse=True, return_counts=True)
                whole = (times[back] > 1) | np.isin(mine, _within(*_wanted(part.column("paths"))))
                step = np.zeros(len(h) + 1, np.int64)
                np.add.at(step, s0[whole], 1)
                np.add.at(step, s1[whole] + span, -1)
                left = ~whole & np.isin(doc, np.unique(_wanted(part.column("edges"))[0]))
                n = (s1 - s0 + 1)[left]
                at = ranges(s0[left], n)
                at = at[np.isin(_within(np.repeat(doc[left], n), _edges(h, at, span)), _within(*_wanted(part.column("edges"))))]
                np.add.at(step, at, 1)
                np.add.at(step, at + span, -1)
                gone = np.cumsum(step[:-1]) > 0
                yield _result(part, buf, off, start, end, first, gone)
    return run


def _result(part, buf, off, start, end, first, gone) -> pa.RecordBatch:
    words = np.diff(first)
    doc = np.repeat(np.arange(len(words)), words)
    # spans of removed words, as coordinates inside their document
    before = np.concatenate(([False], gone[:-1])) if len(gone) else gone
    after = np.concatenate((gone[1:], [False])) if len(gone) else gone
    inner = np.zeros(len(gone) + 1, bool)
    inner[first[:-1]] = True
    a = np.flatnonzero(gone & (~before | inner[:-1]))
    b = np.flatnonzero(gone & (~after | inner[1:]))
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(a, first).astype(np.int32)),
        pa.StructArray.from_arrays([i64(a - first[doc[a]]), i64(b + 1 - first[doc[a]])], ["start", "end"]))
    # kept words with one space between: each kept word's bytes and the byte after it, but for a text's last
    kept = ~gone
    last = np.zeros(len(words), np.int64) - 1
    at = np.flatnonzero(kept)
    np.maximum.at(last, doc[at], at)
    mark = np.zeros(len(buf) + 2, np.int32)
    gap = np.ones(len(start), np.int64)
    gap[last[last >= 0]] = 0
    mark[start[at]] += 1
    np.add.at(mark, end[at] + gap[at], -1)
    take = np.cumsum(mark[:len(buf)]) > 0
    out = buf.copy()
    out[end[at][gap[at] == 1]] = 0x20
    size = np.concatenate(([0], np.cumsum(take)))[off]
    kept_text = pa.StringArray.from_buffers(len(words), pa.py_buffer((size - size[0]).astype(np.int32)), pa.py_buffer(out[take]))
    removed = np.bincount(doc[gone], minlength=len(words)) if len(words) else words
    return pa.RecordBatch.from_arrays([part.column("doc_id"), i64(words), i64(removed), spans, kept_text],
                                      ["doc_id", "n_words", "n_removed", "spans", "kept_text"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 35, k: int = 11) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept_text): words in repeated windows of ``span`` words removed.

    ``spans`` are the removed runs of words (start, end exclusive); ``kept_text`` joins the rest by one space.
    """
    spark = small_batches(docs.sparkSession)
    source = row_key(docs, id_col, text_col)
    id_type = source.schema["doc_id"].dataType.simpleString()
    paths = source.select("rid", "text").mapInArrow(_path_rows(span, k), "m long, path long, rid binary, n long")
    nodes = stored(spark, paths.groupBy("m").agg(F.sum("n").alias("seen"), F.min("path").alias("lo"), F.max("path").alias("hi"))
                   .filter("seen > 1"), "nodes")
    met = stored(spark, join_counted(paths, nodes, "m", "seen", "xxhash64(rid)")
                 .select("m", "path", "rid", (F.col("n") < F.col("seen")).alias("elsewhere"), "n",
                         (F.col("lo") == F.col("hi")).alias("straight")), "met")
    straight = met.filter("straight and elsewhere").select("rid", "path")
    branching = met.filter("not straight")
    kinds = branching.groupBy("m", "path").agg(F.sum("n").alias("seen"), F.min("rid").alias("rid"))
    again = kinds.filter("seen > 1").select("m", "path", "seen")
    repeated = join_counted(branching.select("m", "path", "rid"), again, "path", "seen", "xxhash64(rid)", also=("m",)).select("rid", "path")
    wanted = kinds.groupBy("rid").agg(F.collect_list(F.when(F.col("seen") > 1, F.col("path"))).alias("paths"),
                                      F.collect_list(F.when(F.col("seen") == 1, F.col("path"))).alias("solo"))
    edges = stored(spark, wanted.join(source, "rid").select("rid", "doc_id", "text", "paths", "solo")
                   .mapInArrow(_edge_rows(span, k), "m long, edge long, rid binary, solo boolean"), "edges")
    twice = edges.groupBy("edge", "m").agg(F.count("*").alias("seen")).filter("seen > 1")
    found = join_counted(edges.filter("solo").select("m", "edge", "rid"), twice, "edge", "seen", "xxhash64(rid)", also=("m",))
    gone = (straight.select("rid", "path", F.lit(None).cast("long").alias("edge"))
            .unionByName(repeated.select("rid", "path", F.lit(None).cast("long").alias("edge")))
            .unionByName(found.select("rid", F.lit(None).cast("long").alias("path"), "edge"))
            .groupBy("rid").agg(F.collect_list("path").alias("paths"), F.collect_list("edge").alias("edges")))
    return (source.join(gone, "rid", "left").select("doc_id", "text", "paths", "edges")
            .mapInArrow(_cut(span, k), f"doc_id {id_type}, n_words long, n_removed long, "
                                       "spans array<struct<start:long,end:long>>, kept_text string"))
