"""Cross-tokenizer alignment: groups of two tokenizations by pointer jumping, and how often token pairs end together.

A text is encoded as space + text by a byte-level BPE (A) and as text by a SentencePiece model that adds the space (B). Tokens cover byte
ranges. Every token points to the token of the other encoding that reaches farthest to the right among those it overlaps; one that ends
where its partner ends is a terminal (an A token). Doubling the pointers of all tokens of a block at once converges to each component's
terminal, which labels the group: the shortest stretch of both encodings that ends at the same byte. The two tokens that end there
are a link.

Pass 1 (``encoded``) encodes texts in blocks of about ``BLOCK`` bytes, writes each document's groups as a digest and its links as
indices into the block's distinct id pairs, and the pairs once a block with their counts. Pair counts are summed over all blocks, then each
block asks for the counts of its own distinct pairs: a pair is asked for once a block at most, so no pair is a hot key,
and what is shuffled is a fraction of the links. Pass 2 sums them over each document's links.

A single space between two other characters starts a token on both sides whatever stands around it, so texts fall into units there that
share no token or group. A block encodes and aligns each distinct unit once; memory follows the block, or the longest text without such
spaces. Texts that are null or empty, or whose joined token bytes of A or B differ from
space + text, have no tokens. Special tokens' strings inside texts are plain text. Rows that repeat are rows each; extra columns are
ignored; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import itertools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import distinct_spans, list_lengths, ranges, release, small_batches, stored, text_bytes

#: Bytes of text of a block (or one longer text), and of units that are encoded at once.
BLOCK, JOINED = 4 << 20, 1 << 17
MARK = "▁"


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Coder:
    """Ids and byte lengths of texts under one tokenizer; ``spelled``: the bytes of every id."""

    def __init__(self, spelled: list[bytes]):
        self.size = np.array([len(b) for b in spelled], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.names = np.array([str(i) for i in range(len(spelled))], object)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[ranges(self.start[ids], self.size[ids])]


class ByteLevel(Coder):
    """A byte-level BPE from a ``tokenizers`` JSON file's content; texts get a space in front."""

    def __init__(self, content: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.encode_special_tokens = True
        letters = byte_characters()
        spelled = [b""] * (max(self.tokenizer.get_vocab().values(), default=-1) + 1)
        for piece, i in self.tokenizer.get_vocab().items():
            spelled[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        super().__init__(spelled)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces(Coder):
    """A SentencePiece model that puts a space in front by itself."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        ids = range(self.model.vocab_size())
        spelled = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in zip(ids, self.model.id_to_piece(list(ids)), strict=True)]
        super().__init__(spelled)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int32) for ids in self.model.encode(texts, num_threads=1)]


_CODERS: dict[str, tuple[ByteLevel, Pieces]] = {}


def coders(a: str, b: bytes) -> tuple[ByteLevel, Pieces]:
    """Both tokenizers; kept for the process."""
    key = hashlib.sha256(a.encode() + b"\0" + b).hexdigest()
    if key not in _CODERS:
        _CODERS[key] = (ByteLevel(a), Pieces(b))
    return _CODERS[key]


def _spaces() -> np.ndarray:
    """Code points that some rule takes as white space, and the piece mark; the last entry stands for all higher ones."""
    out = np.zeros(0x3002, bool)
    for lo, hi in ((0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x180E, 0x180E), (0x2000, 0x200B), (0x2028, 0x2029),
                   (0x202F, 0x202F), (0x205F, 0x205F), (0x2581, 0x2581), (0x3000, 0x3000)):
        out[lo:hi + 1] = True
    return out


_SPACES = _spaces()


def units(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units start, in bytes of texts with a space in front: at a text, and at a single space between two other characters, where
    both tokenizers start a new token whatever stands around it. And whether a unit begins and ends so that others may stand beside it."""
    point = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.flatnonzero((buf & 0xC0) != 0x80)  # the first byte of each character
    space = np.append(_SPACES[np.minimum(point, len(_SPACES) - 1)], True)
    new = np.zeros(len(point) + 1, bool)
    new[1:-1] = (point[1:] == 0x20) & ~space[:-2] & ~space[2:]
    new[np.searchsorted(at, off[:-1][off[:-1] < off[1:]])] = True
    first = np.flatnonzero(new[:-1])
    last = np.append(first[1:], len(point)) - 1
    return at[first], (last > first) & ~space[np.minimum(first + 1, len(point))] & ~space[last]


def encode_units(coder: Coder, buf: np.ndarray, start: np.ndarray, size: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the units one after another, how many each has, and whether their bytes are the unit's.

    Units that may stand side by side are encoded as one text of about ``JOINED`` bytes, the others by themselves.
    """
    n = len(start)
    text = lambda a, b: a[b].tobytes().decode("utf-8", "replace")[1:]  # noqa: E731 (the coder puts the space in front)
    parts, owner, count, exact = [], [], np.zeros(n, np.int64), np.zeros(n, bool)
    alone = np.flatnonzero(~plain).tolist()
    joint = np.flatnonzero(plain)
    total = np.cumsum(size[joint])
    at = 0
    while at < len(joint):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + JOINED, "right")))
        mine = joint[at:to]
        bytes_ = buf[ranges(start[mine], size[mine])]
        ids = coder.encode([text(bytes_, slice(None))])[0]
        ends = np.cumsum(coder.size[ids])
        if len(ids) and ends[-1] == len(bytes_) and (coder.joined(ids) == bytes_).all():
            unit_end = np.searchsorted(ends, np.cumsum(size[mine]))  # the token that ends a unit
            count[mine], exact[mine] = np.diff(unit_end, prepend=-1), True
            parts.append(ids)
            owner.append(mine)
        else:
            alone += mine.tolist()
        at = to
    for u in alone:
        bytes_ = buf[start[u]:start[u] + size[u]]
        ids = coder.encode([text(bytes_, slice(None))])[0]
        exact[u] = np.array_equal(coder.joined(ids), bytes_)
        if exact[u]:
            count[u] = len(ids)
            parts.append(ids)
            owner.append(np.array([u]))
    if not parts:
        return np.zeros(0, np.int32), count, exact
    ids, owner = np.concatenate(parts), np.concatenate(owner)
    place = np.zeros(n, np.int64)
    place[owner] = np.cumsum(count[owner]) - count[owner]
    return ids[ranges(place, count)], count, exact


def align(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group of each A and B token, and the terminal A token of each group; ends in bytes, both up to the same last byte."""
    na, nb = len(a_end), len(b_end)
    # the farthest of the other side that a token overlaps is the one over its last byte
    partner = np.searchsorted(b_end, a_end)
    up = np.concatenate((np.where(b_end[partner] > a_end, na + partner, np.arange(na)), np.searchsorted(a_end, b_end)))
    while True:
        further = up[up]
        if (further == up).all():
            break
        up = further
    terminals = np.flatnonzero(up[:na] == np.arange(na))
    group = np.searchsorted(terminals, up)
    return group[:na], group[na:], terminals


def _sums_of(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of runs of ``count`` values each."""
    return np.diff(np.concatenate(([0], np.cumsum(values)))[np.concatenate(([0], np.cumsum(count)))])


def _written(names: np.ndarray, codes: np.ndarray, follows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each unit's ids in order, each with the sign that follows it."""
    pieces = np.empty(2 * len(codes), object)
    pieces[0::2], pieces[1::2] = names[codes], np.array([",", "|", ";", ""], object)[follows]
    pieces = pieces.tolist()
    out = np.empty(len(first) - 1, object)
    out[:] = ["".join(pieces[2 * a:2 * b]) for a, b in itertools.pairwise(first.tolist())]
    return out


def aligned_block(a: Coder, b: Coder, buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray | list[str]]:
    """Of each text of a block: tokens of both sides, groups, the digest of its groups; all links as indices into the block's distinct pairs
    (a << 32 | b), text by text; and those pairs with their counts. A unit that repeats in the block is aligned once."""
    n = len(off) - 1
    some = (np.diff(off) > 0).astype(np.int64)
    spaced = np.full(len(buf) + int(some.sum()), 0x20, np.uint8)  # a space in front of every text that is not empty
    spaced[np.arange(len(buf)) + np.repeat(np.cumsum(some), np.diff(off))] = buf
    off = off + np.concatenate(([0], np.cumsum(some)))
    start, plain = units(spaced, off)
    size = np.diff(np.append(start, len(spaced)))
    text = np.searchsorted(off, start, "right") - 1
    one, same = distinct_spans(spaced, start, size)
    start, size, plain = start[one], size[one], plain[one]
    (a_ids, a_count, a_exact), (b_ids, b_count, b_exact) = (encode_units(c, spaced, start, size, plain) for c in (a, b))
    exact = a_exact & b_exact
    ok = np.bincount(text, ~exact[same], n) == 0  # a text's joined bytes differ where a unit's do
    a_ids, a_count = a_ids[np.repeat(exact, a_count)], a_count * exact
    b_ids, b_count = b_ids[np.repeat(exact, b_count)], b_count * exact
    a_end, b_end = np.cumsum(a.size[a_ids]), np.cumsum(b.size[b_ids])
    a_group, b_group, last_a = align(a_end, b_end)
    last_b = np.searchsorted(b_end, a_end[last_a])
    a_unit = np.repeat(np.arange(len(one)), a_count)
    groups = np.bincount(a_unit[last_a], minlength=len(one))
    # all ids in the order of their groups, A before B, each with what follows it: , | ; or nothing after a unit
    order = np.argsort(np.concatenate((2 * a_group, 2 * b_group + 1)), kind="stable")
    follows = np.zeros(len(a_ids) + len(b_ids), np.int8)
    follows[last_a] = 1
    follows[len(a_ids) + last_b] = 2
    follows[len(a_ids) + last_b[np.cumsum(groups)[groups > 0] - 1]] = 3
    first = np.concatenate(([0], np.cumsum(a_count + b_count)))
    said = _written(a.names if len(a.names) >= len(b.names) else b.names, np.concatenate((a_ids, b_ids))[order], follows[order], first)
    kept = ok[text]
    same, text = same[kept], text[kept]
    said, begin = said[same].tolist(), np.searchsorted(text, np.arange(n + 1)).tolist()
    digests = [hashlib.sha256(";".join(said[x:y]).encode()).hexdigest() if y > x else "" for x, y in itertools.pairwise(begin)]
    pairs, index = np.unique(a_ids[last_a].astype(np.int64) << 32 | b_ids[last_b], return_inverse=True)
    links = index[ranges((np.cumsum(groups) - groups)[same], groups[same])]
    count = np.bincount(links, minlength=len(pairs))
    place = np.cumsum(count > 0) - 1  # pairs of units that stand only in texts without tokens fall away
    total = lambda x: np.bincount(text, x[same], n).astype(np.int64)
    return {"n_a": total(a_count), "n_b": total(b_count), "n_groups": total(groups), "digest": digests,
            "links": place[links], "pairs": pairs[count > 0], "counts": count[count > 0]}


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values, kind))


def _encode(a_file: str, b_file: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = coders(a_file, b_file)
        part, block = TaskContext.get().partitionId(), 0
        for batch in batches:
            buf, off = text_bytes(batch.column("text"))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(off, off[at] + BLOCK, "right")) - 1)
                rows = batch.slice(at, to - at)
                x = aligned_block(a, b, buf[off[at]:off[to]], off[at:to + 1] - off[at])
                mine = np.zeros(to - at, np.int64)
                mine[0] = len(x["pairs"])  # a block's first row carries its pairs
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(np.full(to - at, part << 32 | block)), pa.array(x["n_a"]), pa.array(x["n_b"]), pa.array(x["n_groups"]),
                     pa.array(x["digest"], pa.string()), _lists(x["links"], x["n_groups"], pa.int32()), _lists(x["pairs"], mine, pa.int64()), _lists(x["counts"], mine, pa.int64())],
                    ["doc_id", "block", "n_a", "n_b", "n_groups", "groups_sha256", "links", "pairs", "counts"])
                at, block = to, block + 1
        release()
    return run


def encoded(docs: DataFrame, a_file: str, b_file: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored pass 1: doc_id, block, n_a, n_b, n_groups, groups_sha256, links (indices into the block's pairs), and in the first row of each block its
    distinct pairs (a << 32 | b) and their counts."""
    spark = small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return stored(spark, source.mapInArrow(_encode(a_file, b_file), f"doc_id {kind}, block long, n_a long, n_b long, n_groups long, groups_sha256 string, "
                                           "links array<int>, pairs array<long>, counts array<long>"), "encoded")


def pair_counts(coded: DataFrame) -> DataFrame:
    """Stored (pair, count, best): how many links hold an id pair, and whether that is its B id's highest."""
    spark = coded.sparkSession
    each = coded.filter("size(pairs) > 0").select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    count = stored(spark, each.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))), "pairs")
    top = count.groupBy("b").agg(F.max("count").alias("most"))
    return stored(spark, count.join(top, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "counts")


def _sums(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Of one block: its documents' sums over their links."""
    place = right.column("place").to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place], best[place] = right.column("count").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
    lengths, flat = list_lengths(left.column("links").combine_chunks())
    links = flat.to_numpy(zero_copy_only=False).astype(np.int64)
    rest = left.drop_columns(["block", "links"])
    return rest.append_column("n_best", pa.array(_sums_of(best[links], lengths))).append_column("count_sum", pa.array(_sums_of(count[links], lengths)))


def align_corpus(docs: DataFrame, a_file: str, b_file: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    ``a_file``: content of a byte-level ``tokenizers`` JSON file; ``b_file``: a serialized SentencePiece model. ``n_best``: links whose pair's count is the
    highest of its B id in the corpus, ties included; ``count_sum``: sum of the links' pair counts.
    """
    coded = encoded(docs, a_file, b_file, id_col, text_col)
    counts = pair_counts(coded)
    asked = coded.filter("size(pairs) > 0").select("block", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(counts, "pair").select(F.col("block").alias("asker"), "place", "count", "best")
    mine = coded.filter("n_groups > 0").select("doc_id", "block", "n_a", "n_b", "n_groups", "groups_sha256", "links")
    kind = coded.schema["doc_id"].dataType.simpleString()
    sums = mine.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(
        _sums, f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long")
    none = coded.filter("n_groups = 0").select("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    return sums.unionByName(none).select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
