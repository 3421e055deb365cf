"""Helpers of the llm operators: vectorised words and hashes, stored tables, hot keys."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.session import shared_dir

#: Bytes of text that one vectorised step works on; a longer text is a step of its own.
BLOCK_BYTES = 2 << 20
#: Bytes of a batch of rows between Spark and its Python workers; both sides hold a few of them.
BATCH_BYTES = 8 << 20
_CHUNK = 1 << 18
_U = np.uint64


# --------------------------------------------------------------------------- tables

def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder (``spark.checkpoint.dir``) and read it back.

    Cuts lineage in a way that outlives executors.
    """
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def release() -> None:
    """Give memory that a worker no longer uses back to the system; a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # a C library without it keeps its own free lists
        pass


def small_batches(spark: SparkSession) -> SparkSession:
    """Have Spark hand texts to Python in batches of ``BATCH_BYTES``; its default of 64 MB costs each worker and
    its executor several times that."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def row_hash(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """128 bits (16 bytes) of id and text: equal for rows that repeat, other for others; null is no value."""
    key = F.col(id_col).cast("string")
    key = F.coalesce(F.concat(F.length(key).cast("string"), F.lit(":"), key), F.lit("null:"))
    return F.unhex(F.md5(F.concat(key, F.coalesce(F.concat(F.lit("="), F.col(text_col)), F.lit("")))))


def row_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, id, text): rid is ``row_hash``, so rows that repeat share it."""
    return docs.select(row_hash(id_col, text_col).alias("rid"),
                       F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def join_counted(left: DataFrame, right: DataFrame, key: str, count: str, spread: str,
                 keep: int = 1000, salts: int = 32, also: tuple[str, ...] = ()) -> DataFrame:
    """Inner join of ``left`` with ``right`` (one row per key and its ``count`` in left), on ``key`` and the columns ``also``.

    Keys with at least 1/``keep`` of the counted rows, of which there are at most ``keep``,
    are salted by the whole number ``spread`` (SQL); only those keys are broadcast.
    """
    total = right.agg(F.sum(count)).first()[0] or 0
    often = right.filter(F.col(count) * keep > F.lit(total)).filter(F.col(count) > 1000).select(key)
    hot = [r[0] for r in (often.distinct() if also else often).collect()]
    if not hot:
        return left.join(right, [key, *also])
    is_hot = F.col(key).isin(hot) if len(hot) < 50 else F.array_contains(F.array(*map(F.lit, hot)), F.col(key))
    salted = left.withColumn("__salt", F.when(is_hot, F.pmod(F.expr(spread), F.lit(salts))).otherwise(F.lit(0)).cast("int"))
    each = right.withColumn("__salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1)))
                                                .otherwise(F.array(F.lit(0)))))
    return salted.join(each, [key, *also, "__salt"]).drop("__salt")


# --------------------------------------------------------------------------- bytes and words

def lut(*ranges: tuple[int, int]) -> np.ndarray:
    """256 booleans, true in the given byte ranges (ends included)."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a:b + 1] = True
    return out


#: Separators of ``[^\x20\x09-\x0D]+``.
SPACE = lut((0x20, 0x20), (0x09, 0x0D))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, and where each text starts (and the last ends). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, wide)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def blocks(batch: pa.RecordBatch, text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of ``batch`` with at most ``limit`` bytes of text (or one row), their bytes and offsets."""
    buf, off = text_bytes(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at), buf[off[at]:off[to]], off[at:to + 1] - off[at]
        at = to


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base`` and its inverse to the powers 0..n-1, modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        n = max(n, _CHUNK + 4096)
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(n, b, _U)
            p[0] = 1
            pair.append(np.multiply.accumulate(p))
        have = _POWERS[base] = (pair[0], pair[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's end)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[start:end] for ascending starts, by differences of prefix sums."""
    out = np.empty(len(start), _U)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(start, start[at] + _CHUNK)))
        lo, hi = int(start[at]), int(end[at:to].max())
        p, inv = powers(base, hi - lo + 1)
        sums = np.zeros(hi - lo + 1, _U)
        np.cumsum((values[lo:hi].astype(_U) + _U(1)) * p[:hi - lo], out=sums[1:])
        s, e = start[at:to] - lo, end[at:to] - lo
        out[at:to] = mix((sums[e] - sums[s]) * inv[s] + (e - s).astype(_U) * _U(0x9E3779B97F4A7C15))
        at = to
    return out


WORD_BASE = 0x9D8A7B6C5F4E3D2B


def word_bounds(buf: np.ndarray, off: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of the words (runs of non-separators), and each text's first word (and the end)."""
    inside = ~sep[buf]
    before = np.zeros(len(buf) + 1, bool)
    before[1:] = inside
    after = before[1:].copy()
    edge = off[:-1][off[:-1] < off[1:]]
    before = before[:-1]
    before[edge] = False
    start = np.flatnonzero(inside & ~before)
    after[:-1] = inside[1:]
    if len(after):
        after[-1] = False
    last = off[1:][off[:-1] < off[1:]] - 1
    after[last] = False
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, off)


def windows_hash(h: np.ndarray, n: int, base: int) -> np.ndarray:
    """Hash of each n consecutive values (texts' borders are not minded)."""
    start = np.arange(max(0, len(h) - n + 1))
    return spans_hash(h, start, start + n, base)


def distinct_spans(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct span buf[start:start+size], and which of them each span equals; the bytes are compared."""
    _, first, same = np.unique(spans_hash(buf, start, start + size, WORD_BASE), return_index=True, return_inverse=True)
    equal = size == size[first][same]
    at = np.flatnonzero(equal)
    differ = buf[ranges(start[at], size[at])] != buf[ranges(start[first][same[at]], size[at])]
    equal[at[np.unique(np.searchsorted(np.cumsum(size[at]), np.flatnonzero(differ), "right"))]] = False
    odd = np.flatnonzero(~equal)
    same[odd] = len(first) + np.arange(len(odd))
    return np.concatenate((first, odd)), same


def sliding_argmin(v: np.ndarray, w: int) -> np.ndarray:
    """Index of the leftmost least value in each window of w values."""
    n, val, idx, size = len(v) - w + 1, v, np.arange(len(v)), 1
    if n <= 0:
        return np.zeros(0, np.int64)
    while size < w:
        step = min(size, w - size)
        a, b = val[:len(val) - step], val[step:]
        left = a <= b
        idx = np.where(left, idx[:len(a)], idx[step:])
        val = np.where(left, a, b)
        size += step
    return idx[:n]


def i64(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == _U else x.astype(np.int64))


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers start[i] .. start[i]+length[i]-1, one run after another."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.repeat(start - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(total)


def list_lengths(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Lengths (null: 0) and the joined values of a list column."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lengths, column.flatten()
