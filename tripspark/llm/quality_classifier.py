"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network with calibrated probabilities.

Words are runs of letters, of digits or of other signs (spaces part them); a word's hash names one of ``slots`` slots. Every slot has a sparse
index vector (``NONZERO`` signs at places drawn from the slot's hash). The context vector of a slot is the sum of the index vectors of all
words up to ``REACH`` places from its occurrences, over the whole corpus: whole numbers, so the sums do not depend on order or on
how tasks are cut. A task adds up its rows and emits its table in pieces of ``PIECE`` slots; pieces are summed in two steps (first by part of
the tasks), streaming, so memory is the table's own size: slots x (dimensions + 1) numbers, which is also what is broadcast.

A document is the mean and the spread of its words' vectors (centred, scaled to length 1, frequent words weighted down), with a few
plain figures of its words. A network of two layers is fitted in numpy on a bounded sample of labelled documents, whose pooled vectors
alone reach the driver; a fifth of the sample is kept apart to stop the training and to fit the temperature that divides the logits.

Null and empty texts have zero vectors and are scored by the network like any other. Rows that repeat count in the corpus and are scored each.
Labels that are null or have no document are not used. With one class only among the labels every score is the share of label 1
(0.5 without labels). Extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import WORD_BASE, blocks, lut, mix, release, small_batches, spans_hash, stored

#: Words on either side that count as context; signs of an index vector; slots of a piece of the table.
REACH, NONZERO, PIECE = 2, 4, 256
#: Weight of a word of relative frequency p: RARE / (RARE + p).
RARE = 1e-3
#: Plain figures beside the pooled vectors.
FIGURES = 6
_U = np.uint64

_KIND = np.full(256, 3, np.uint8)  # 0 space, 1 letters, 2 digits, 3 other signs; bytes of other scripts are letters
_KIND[lut((0x20, 0x20), (0x09, 0x0D))] = 0
_KIND[lut((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))] = 1
_KIND[lut((0x30, 0x39))] = 2


def words(buf: np.ndarray, off: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Slot, kind and size of each word of a block, and each text's first word (and the end)."""
    kind = _KIND[buf]
    new = np.ones(len(buf), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[off[:-1][off[:-1] < off[1:]]] = True
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(buf))
    real = kind[start] > 0
    start, end = start[real], end[real]
    slot = (spans_hash(buf, start, end, WORD_BASE) >> _U(17)) % _U(slots)
    return slot.astype(np.int64), kind[start], end - start, np.searchsorted(start, off)


def index_vectors(slots: int, dims: int) -> np.ndarray:
    """The sparse index vector of every slot."""
    out = np.zeros((slots, dims), np.int8)
    slot = np.arange(slots)
    for k in range(NONZERO):
        h = mix(np.arange(slots, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(k + 1))
        out[slot, (h >> _U(1)) % _U(dims)] += np.where(h & _U(1), 1, -1).astype(np.int8)
    return out


def add_contexts(table: np.ndarray, index: np.ndarray, slot: np.ndarray, first: np.ndarray) -> None:
    """Add a block's context vectors and counts to ``table`` (slots x (dimensions + 1))."""
    n = len(slot)
    if not n:
        return
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for lo in range(0, n, 1 << 16):
        hi = min(n, lo + (1 << 16))
        left, right = max(lo - REACH, 0), min(hi + REACH, n)
        vectors = index[slot[left:right]].astype(np.int16)  # of the words and those around, taken once for all shifts
        near = np.zeros((hi - lo, index.shape[1]), np.int16)
        for shift in (*range(-REACH, 0), *range(1, REACH + 1)):
            a, b = max(lo, -shift), min(hi, n - shift)
            if a >= b:
                continue
            to, other = near[a - lo:b - lo], vectors[a + shift - left:b + shift - left]
            to += other
            apart = np.flatnonzero(text[a:b] != text[a + shift:b + shift])  # words of another text
            to[apart] -= other[apart]
        here = slice(lo, hi)
        order = np.argsort(slot[here], kind="stable")
        mine = slot[here][order]
        heads = np.flatnonzero(np.diff(mine, prepend=-1))
        table[mine[heads], :-1] += np.add.reduceat(near[order], heads, axis=0, dtype=np.int32)
        table[mine[heads], -1] += np.diff(np.append(heads, len(mine)))


def _pieces(part: int, table: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(table), PIECE):
        rows = np.ascontiguousarray(table[at:at + PIECE])
        if rows[:, -1].any():
            yield pa.RecordBatch.from_arrays([pa.array([at // PIECE], pa.int32()), pa.array([part], pa.int32()), pa.array([rows.tobytes()], pa.binary())], ["piece", "part", "sums"])


def _contexts(slots: int, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = index = None
        for batch in batches:
            for _, buf, off in blocks(batch):
                if table is None:
                    table, index = np.zeros((slots, dims + 1), np.int64), index_vectors(slots, dims)
                slot, _, _, first = words(buf, off, slots)
                add_contexts(table, index, slot, first)
        if table is not None:
            yield from _pieces(TaskContext.get().partitionId(), table)
        release()
    return run


def _summed(dims: int):
    """Sums of the pieces of a task's partition, one array for each piece at a time in memory."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for piece, part, data in zip(*(batch.column(c).to_pylist() for c in ("piece", "part", "sums")), strict=True):
                rows = np.frombuffer(data, np.int64).reshape(-1, dims + 1)
                if (piece, part) in sums:
                    sums[piece, part] += rows
                else:
                    sums[piece, part] = rows.copy()
        for (piece, part), rows in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([part], pa.int32()), pa.array([rows.tobytes()], pa.binary())], ["piece", "part", "sums"])
    return run


@dataclass
class Vectors:
    """``unit``: each slot's vector, 0 for slots without words; ``weight``: of a word in its document's mean."""

    unit: np.ndarray
    weight: np.ndarray


def word_vectors(docs: DataFrame, slots: int = 1 << 15, dims: int = 48, text_col: str = "text", parts: int = 64) -> Vectors:
    """Context vectors over all of ``docs``. ``parts``: groups of tasks that are summed first."""
    spark = small_batches(docs.sparkSession)
    kinds = "piece int, part int, sums binary"
    each = docs.select(F.col(text_col).alias("text")).filter("text is not null").mapInArrow(_contexts(slots, dims), kinds)
    some = each.withColumn("part", F.pmod("part", F.lit(parts))).repartition("piece", "part").mapInArrow(_summed(dims), kinds)
    whole = stored(spark, some.withColumn("part", F.lit(0)).repartition("piece").mapInArrow(_summed(dims), kinds), "vectors")
    table = np.zeros((slots, dims + 1))
    for r in whole.toLocalIterator():  # slots x (dims + 1) numbers
        rows = np.frombuffer(r.sums, np.int64).reshape(-1, dims + 1)
        table[r.piece * PIECE:r.piece * PIECE + len(rows)] = rows
    return _vectors(table)


def _vectors(table: np.ndarray) -> Vectors:
    count = table[:, -1]
    total = max(count.sum(), 1.0)
    vector = table[:, :-1] / np.maximum(count, 1)[:, None]
    vector -= (vector * count[:, None]).sum(0) / total
    size = np.linalg.norm(vector, axis=1)
    vector[(count == 0) | (size < 1e-9)] = 0
    return Vectors((vector / np.maximum(size, 1e-9)[:, None]).astype(np.float32), (RARE / (RARE + count / total)).astype(np.float32))


def pooled(buf: np.ndarray, off: np.ndarray, v: Vectors) -> np.ndarray:
    """A row for each text of a block: mean and spread of its words' vectors, and plain figures."""
    slot, kind, size, first = words(buf, off, len(v.weight))
    n, dims = len(off) - 1, v.unit.shape[1]
    out = np.zeros((n, 2 * dims + FIGURES), np.float32)
    count = np.diff(first)
    has = np.flatnonzero(count)
    if not len(has):
        return out
    text = np.repeat(np.arange(n), count)
    w = v.weight[slot]
    total = np.maximum(np.bincount(text, w, n), 1e-12)[:, None]
    mean, square = np.zeros((n, dims)), np.zeros((n, dims))
    for lo in range(0, len(slot), 1 << 16):
        part = slice(lo, lo + (1 << 16))
        x = v.unit[slot[part]] * w[part, None]
        heads = np.flatnonzero(np.diff(text[part], prepend=-1))
        mean[text[part][heads]] += np.add.reduceat(x, heads, axis=0, dtype=np.float64)
        square[text[part][heads]] += np.add.reduceat(x * v.unit[slot[part]], heads, axis=0, dtype=np.float64)
    mean, square = mean / total, square / total
    out[:, :dims], out[:, dims:2 * dims] = mean, np.sqrt(np.maximum(square - mean * mean, 0))
    same = np.zeros(len(slot), bool)
    same[1:] = (slot[1:] == slot[:-1]) & (text[1:] == text[:-1])
    key = np.unique(text * len(v.weight) + slot)
    distinct = np.bincount(key // len(v.weight), minlength=n)
    some = np.maximum(count, 1)
    out[:, 2 * dims:] = np.column_stack([
        np.log1p(count), distinct / some, np.bincount(text, same, n) / some, np.bincount(text, kind == 3, n) / some,
        np.bincount(text, kind == 2, n) / some, np.log1p(np.bincount(text, size, n) / some)])
    return out


# --------------------------------------------------------------------------- network

@dataclass
class Network:
    """Two layers on standardised inputs; ``temperature`` divides the logit. ``base``: the score where there was nothing to learn."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0
    base: float | None = None

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(np.clip((x - self.centre) / self.scale, -5, 5) @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.base is not None:
            return np.full(len(x), self.base)
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def constant(inputs: int, base: float) -> Network:
    """A network that gives ``base`` to every text."""
    return Network(np.zeros(inputs), np.ones(inputs), np.zeros((inputs, 1)), np.zeros(1), np.zeros(1), 0.0, base=base)


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def fit_network(x: np.ndarray, y: np.ndarray, apart: np.ndarray, hidden: int = 24, rounds: int = 150, batch: int = 64, rate: float = 3e-3,
                ridge: float = 1e-3, patience: int = 20, seed: int = 7) -> Network:
    """Adam on the rows not ``apart``; the best round on those apart is kept, and the temperature fitted on them."""
    if not 0 < y.mean() < 1:
        return constant(x.shape[1], float(y.mean()))
    r = np.random.default_rng(seed)
    fit = ~apart
    if not apart.any() or not fit.any():
        fit = apart = np.ones(len(y), bool)
    xf, yf, xa, ya = x[fit], y[fit], x[apart], y[apart]
    net = Network(xf.mean(0), np.maximum(xf.std(0), 1e-4), r.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
                  r.normal(0, 1 / np.sqrt(hidden), hidden), 0.0)
    xs = np.clip((xf - net.centre) / net.scale, -5, 5)
    params = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    best, kept, step, waited = np.inf, [p.copy() for p in params], 0, 0
    for _ in range(rounds):
        order = r.permutation(len(yf))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            h = np.tanh(xs[rows] @ params[0] + params[1])
            z = h @ params[2] + params[3]
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - yf[rows]) / len(rows)
            back = g[:, None] * params[2] * (1 - h * h)
            grads = [xs[rows].T @ back + ridge * params[0], back.sum(0), h.T @ g + ridge * params[2], np.array([g.sum()])]
            step += 1
            for p, d, m, s in zip(params, grads, first, second, strict=True):
                m += 0.1 * (d - m)
                s += 0.001 * (d * d - s)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
        net.b2 = float(params[3][0])
        now = _loss(net.logit(xa), ya)
        if now < best - 1e-5:
            best, kept, waited = now, [p.copy() for p in params], 0
        else:
            waited += 1
            if waited >= patience:
                break
    net.w1, net.b1, net.w2, net.b2 = kept[0], kept[1], kept[2], float(kept[3][0])
    net.temperature = fit_temperature(net.logit(xa), ya)
    return net


def fit_temperature(z: np.ndarray, y: np.ndarray, lowest: float = 0.25, highest: float = 8.0) -> float:
    """The temperature with the least log loss, by golden section over its logarithm."""
    a, b, g = np.log(lowest), np.log(highest), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - g * (b - a), a + g * (b - a)
        if _loss(z / np.exp(c), y) <= _loss(z / np.exp(d), y):
            b = d
        else:
            a = c
    return float(np.exp((a + b) / 2))


# --------------------------------------------------------------------------- Spark side

@dataclass
class Model:
    vectors: Vectors
    network: Network


def _pooled_rows(v: Vectors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in blocks(batch, limit=1 << 19):
                x = pooled(buf, off, v)
                yield pa.RecordBatch.from_arrays([part.column("label"), part.column("apart"), pa.array(list(x), pa.list_(pa.float32()))], ["label", "apart", "x"])
    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          rows: int = 20_000, slots: int = 1 << 15, dims: int = 48, vectors: Vectors | None = None) -> Model:
    """Word vectors from all texts of ``docs``; the network from about ``rows`` labelled documents (chosen by hash of their ids), a fifth kept apart."""
    v = vectors or word_vectors(docs, slots, dims, text_col)
    labels = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter(
        "doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    n = labels.count()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    apart = F.pmod(F.xxhash64(F.lit("apart"), F.col("doc_id")), F.lit(5)) == 0
    chosen = labels.filter(share * max(n, 1) <= rows).select("doc_id", "label", apart.alias("apart"))
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "label", "apart")
    got = source.mapInArrow(_pooled_rows(v), "label int, apart boolean, x array<float>").toPandas()
    if not len(got):
        return Model(v, constant(2 * v.unit.shape[1] + FIGURES, 0.5))
    x = np.stack(got["x"].to_numpy()).astype(np.float64)
    y = got["label"].to_numpy().astype(np.float64)
    order = np.lexsort(np.column_stack([x, y]).T)  # the result does not depend on the order in which rows arrive
    return Model(v, fit_network(x[order], y[order], got["apart"].to_numpy()[order].astype(bool)))


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in blocks(batch, limit=1 << 19):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.network.score(pooled(buf, off, model.vectors)), pa.float64())], ["doc_id", "score"])
        release()
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): the calibrated probability of label 1 of every text."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_scores(model), f"doc_id {kind}, score double")
