"""Toxicity by a support vector machine on a gap-weighted subsequence string kernel, with Nyström landmarks.

A sentence is judged by its units: words in lower case without anything but letters and digits, and runs
of single letters taken together, so ``i d i o t`` or ``id*iot`` is the unit ``idiot``. The kernel of two units sums,
over all subsequences of three characters that span at most ``SPAN`` characters in each, ``DECAY`` to the two spans, divided by
a factor for either length; inserted characters lower it but don't hide a match. Longer runs of letters are units of ``UNIT`` letters
that overlap by half. Neighbouring units taken together and short windows of long or spelled runs (``joined_of``) are judged too, so
``id iot`` and ``youareanidiot...`` are seen: the best of them is one more unit of its document if it is positive and above all others, and
clean ones join the hard negatives.

Training (a bounded, documented sample of labelled rows): the label belongs to a document, so each toxic document is a bag of
units of which some are insults. Units much more frequent in toxic bags start as positive, units of clean documents are
negative; a support vector machine is fitted on Nyström features of landmark units, every toxic bag then names its best unit, and the fit
is repeated. A logistic model turns a document's best margins into the score.

Scoring all rows: the decision function is a weighted sum of kernels to the landmarks, so it equals a table with a weight
for each three characters. A task sums table entries over its text in vectorised steps: no shuffle, any length of text, nothing
read but the text.

Null and empty texts score like a text without insults. Rows that repeat are scored each. Labels that are null or have no
document are not used. With no labelled row of one of the classes every score is the share of toxic labels (0 without labels).
Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.common import SPACE, blocks, ranges, release, small_batches, word_bounds

SPAN, DECAY = 6, 0.7
LETTERS = 96
GAPS = [(a, b) for a in range(1, SPAN - 1) for b in range(1, SPAN - a)]
#: Longest unit; a longer run of letters is several units, each with the last half of the one before.
UNIT = 24
#: Most letters of two or three neighbouring units taken together; windows of long runs, which step by two letters.
JOINED, SHORT = 12, (6, 8, 10, 12)
#: Units taken together that are judged at once.
AT_ONCE = 1 << 16
#: So many of the surest insults are also learned with an inserted letter.
SPOILT = 40


def _classes() -> np.ndarray:
    """Character classes by code point: 0 none, a-z, digits, Latin-1 letters, the rest of the scripts dealt over 27."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0xAA, 0x30000):
        if chr(c).isalpha():
            out[c] = 69 + c % 27
    for c in range(0x41, 0x100):
        if chr(c).isalpha():
            low = ord(chr(c).lower())
            out[c] = low - 0x60 if low < 0x80 else 37 + low - 0xE0 if low >= 0xE0 else 69 + low % 27
    out[0x30:0x3A] = np.arange(27, 37)
    return out


_TABLE: list[np.ndarray] = []


def classes() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_classes())
    return _TABLE[0]


def length_norm(n: np.ndarray) -> np.ndarray:
    """The kernel's divisor by a unit's length (the root of its weights' squares, each subsequence counted apart)."""
    n = np.asarray(n)
    total = np.zeros(n.shape)
    for a, b in GAPS:
        total += np.maximum(n - a - b, 0) * DECAY ** (2 * (a + b + 1))
    return np.sqrt(np.maximum(total, 1e-9))


def _runs(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """A block's letters by class; first letter, size and text of each run of letters, and whether single letters make it up."""
    start, end, _ = word_bounds(buf, off, SPACE)
    point = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))  # code points before each byte
    cls = classes()[point]
    word = np.repeat(np.arange(len(start)), at[end] - at[start])
    inside = np.zeros(len(point) + 1, np.int64)
    np.add.at(inside, at[start], 1)
    np.add.at(inside, at[end], -1)
    there = np.cumsum(inside[:-1]) > 0
    letter = cls[there]
    real = letter > 0
    letter, word = letter[real], word[real]
    size = np.bincount(word, minlength=len(start))
    text = np.searchsorted(off, start, "right") - 1
    single = size == 1
    new = np.ones(len(start), bool)  # words that begin a unit: all but single letters after single letters
    new[1:] = ~(single[1:] & single[:-1] & (text[1:] == text[:-1]))
    unit = (np.cumsum(new) - 1)[word] if len(start) else word
    first = np.flatnonzero(np.diff(unit, prepend=-1))
    return letter, first, np.diff(first, append=len(unit)), text[word[first]], single[word[first]]


def _windows(first: np.ndarray, size: np.ndarray, text: np.ndarray, width: int, step: int) -> tuple[np.ndarray, ...]:
    """First letter, size and text of windows of ``width`` letters, ``step`` apart, over each run."""
    n = 1 + np.maximum(size - width + step - 1, 0) // step
    run = np.repeat(np.arange(len(first)), n)
    shift = step * ranges(np.zeros(len(n), np.int64), n)
    return first[run] + shift, np.minimum(width, size[run] - shift), text[run]


def _spread(letter: np.ndarray, first: np.ndarray, size: np.ndarray, text: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return letter[ranges(first, size)], np.repeat(np.arange(len(size)), size), np.searchsorted(text, np.arange(texts + 1))


def letters_of(buf: np.ndarray, off: np.ndarray, runs: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's letters: class and unit of each, and each text's first unit (and the end)."""
    letter, first, size, text, _ = runs or _runs(buf, off)
    return _spread(letter, *_windows(first, size, text, UNIT, UNIT // 2), len(off) - 1)


def _joined(runs: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First letter, size and text of two and three neighbouring runs of ``JOINED`` letters at most taken together, and the windows of ``SHORT`` letters of
    runs longer than ``UNIT`` and of spelled ones."""
    _, first, size, text, spelled = runs
    parts = []
    for n in (2, 3):
        m = max(len(first) - n + 1, 0)
        total = sum((size[k:k + m] for k in range(n)), np.zeros(m, np.int64))
        i = np.flatnonzero((text[:m] == text[n - 1:n - 1 + m]) & (total <= JOINED))
        parts.append((first[i], total[i], text[i]))
    for width in SHORT:
        i = np.flatnonzero((size > width) & (spelled | (size > UNIT)))
        parts.append(_windows(first[i], size[i], text[i], width, 2))
    at, total, owner = (np.concatenate([p[k] for p in parts]) for k in range(3))
    order = np.argsort(owner, kind="stable")
    return at[order], total[order], owner[order]


def joined_of(buf: np.ndarray, off: np.ndarray, runs: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``letters_of``, of units taken together."""
    runs = runs or _runs(buf, off)
    return _spread(runs[0], *_joined(runs), len(off) - 1)


def margins(letter: np.ndarray, unit: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """The decision function of every unit: table entries of its subsequences, over the length's divisor."""
    n = int(unit[-1]) + 1 if len(unit) else 0
    total = np.zeros(len(letter), np.float32)
    c = letter.astype(np.int32)
    c1, c2 = c * (LETTERS * LETTERS), c * LETTERS
    for a, b in GAPS:
        m = len(c) - a - b
        if m > 0:
            value = weights[c1[:m] + c2[a:a + m] + c[a + b:]]
            total[:m] += np.where(unit[:m] == unit[a + b:], value, 0) * np.float32(DECAY ** (a + b + 1))
    return np.bincount(unit, total, n) / length_norm(np.bincount(unit, minlength=n)) + bias


def _subsequences(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, three characters, weight over the length's divisor) of every subsequence."""
    cls = classes()
    size = np.array([len(u) for u in units], np.int64)
    c = cls[np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)].astype(np.int64)
    unit = np.repeat(np.arange(len(units)), size)
    who, what, weight = [], [], []
    for a, b in GAPS:
        m = max(len(c) - a - b, 0)
        i = np.flatnonzero(unit[:m] == unit[a + b:a + b + m])
        who.append(unit[i])
        what.append(c[i] * LETTERS * LETTERS + c[i + a] * LETTERS + c[i + a + b])
        weight.append(np.full(len(i), DECAY ** (a + b + 1)))
    who, what, weight = map(np.concatenate, (who, what, weight))
    return who, what, weight / length_norm(size)[who]


def kernel(left: list[str], right: list[str], project: np.ndarray | None = None) -> np.ndarray:
    """Kernel values of all units of ``left`` with those of ``right`` (a bounded list), times ``project`` if given."""
    who, what, weight = _subsequences(right)
    known, place = np.unique(what, return_inverse=True)
    table = np.zeros((len(known) + 1, len(right)), np.float64 if project is None else np.float32)
    np.add.at(table, (place, who), weight)
    out = np.zeros((len(left), len(right) if project is None else project.shape[1]), np.float64 if project is None else np.float32)
    for at in range(0, len(left), 2000):
        part = np.zeros((len(left[at:at + 2000]), len(right)))
        who, what, weight = _subsequences(left[at:at + 2000])
        i = np.searchsorted(known, what)
        i[(i == len(known)) | (known[np.minimum(i, len(known) - 1)] != what)] = len(known)
        real = np.flatnonzero(i < len(known))
        order = real[np.argsort(who[real], kind="stable")]
        some, first = np.unique(who[order], return_index=True)
        for k, j in zip(some, np.split(order, first[1:]), strict=True):
            part[k] = weight[j] @ table[i[j]]
        out[at:at + 2000] = part if project is None else part @ project
    return out


def _steps(parts: list[np.ndarray], rows: int = 2000) -> Iterator[tuple[slice, np.ndarray]]:
    """Rows of all parts, a few at a time in double precision, and their places."""
    at = 0
    for part in parts:
        for i in range(0, len(part), rows):
            x = part[i:i + rows].astype(np.float64)
            yield slice(at, at + len(x)), x
            at += len(x)


def _values(parts: list[np.ndarray], w: np.ndarray) -> np.ndarray:
    """The decision function of all rows; the last coefficient is the bias."""
    out = np.empty(sum(map(len, parts)))
    for place, x in _steps(parts):
        out[place] = x @ w[:-1] + w[-1]
    return out


def fit_svm(parts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, c: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Linear squared-hinge support vector machine by Newton steps; the last coefficient is the bias.

    The rows stay in their parts (single precision); only a few at a time are copied.
    """
    m = parts[0].shape[1] + 1
    w = np.zeros(m)
    ridge = np.eye(m) / c
    ridge[-1, -1] = 1e-3
    active = np.ones(len(y), bool)
    for _ in range(rounds):
        square, right = ridge.copy(), np.zeros(m)
        for place, x in _steps(parts):
            use = active[place]
            x = np.column_stack([x[use], np.ones(int(use.sum()))])
            a = x * weight[place][use, None]
            square += a.T @ x
            right += a.T @ y[place][use]
        w = np.linalg.solve(square, right)
        now = y * _values(parts, w) < 1
        if (now == active).all():
            break
        active = now
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Logistic regression by damped Newton steps; the last coefficient is the bias."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    """``weights``: the decision function by three characters; ``document``: logistic model of a document's margins."""

    weights: np.ndarray
    bias: float
    document: np.ndarray
    landmarks: list[str] = field(default_factory=list)
    base: float | None = None


def _features(margin: np.ndarray, first: np.ndarray, limit: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
    """Per document: best and second margin, units above 0 and 0.5 (logs), and their share; and its best unit."""
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    best, second, which = np.full(n, -limit), np.full(n, -limit), np.full(n, -1)
    order = np.lexsort((margin, doc))
    last = first[1:] - 1
    has, two = np.diff(first) > 0, np.diff(first) > 1
    which[has] = order[last[has]]
    best[has] = margin[which[has]]
    second[two] = margin[order[last[two] - 1]]
    above = [np.bincount(doc[margin > t], minlength=n) for t in (0.0, 0.5)]
    share = above[0] / np.maximum(np.diff(first), 1)
    clip = lambda v: np.clip(v, -limit, limit)
    return np.column_stack([clip(best), clip(second), np.log1p(above[0]), np.log1p(above[1]), np.sqrt(share)]), which


def _judged(buf: np.ndarray, off: np.ndarray, model: Model) -> np.ndarray:
    """``_features`` of a block's texts; a text's best unit taken together is one more unit if it is positive and above all others."""
    runs = _runs(buf, off)
    letter, unit, first = letters_of(buf, off, runs)
    margin = margins(letter, unit, model.weights, model.bias)
    n = len(off) - 1
    best, joined = np.zeros(n), np.full(n, -np.inf)
    np.maximum.at(best, np.repeat(np.arange(n), np.diff(first)), margin)
    at, size, text = _joined(runs)
    for k in range(0, len(at), AT_ONCE):
        part = slice(k, k + AT_ONCE)
        unit = np.repeat(np.arange(len(at[part])), size[part])
        np.maximum.at(joined, text[part], margins(runs[0][ranges(at[part], size[part])], unit, model.weights, model.bias))
    more = joined > best
    return _features(np.insert(margin, first[1:][more], joined[more]), first + np.concatenate(([0], np.cumsum(more))))[0]


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in blocks(batch, limit=1 << 19):
                x = _judged(buf, off, model)
                if model.base is None:
                    score = 1 / (1 + np.exp(-np.clip(np.column_stack([x, np.ones(len(x))]) @ model.document, -30, 30)))
                else:
                    score = np.full(len(x), model.base)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score), pa.array(x[:, 0]), pa.array(x[:, 2])],
                                                 ["doc_id", "score", "margin", "log_hits"])
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, margin, log_hits): each document's score, its best unit's margin, log(1 + units above 0)."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_score(model), f"doc_id {kind}, score double, margin double, log_hits double")


def _spelled(letter: np.ndarray, unit: np.ndarray, chars: list[str]) -> list[str]:
    text = "".join([chars[c] for c in letter.tolist()])
    head = np.flatnonzero(np.diff(unit, prepend=-1))
    return [text[a:b] for a, b in zip(head, [*head[1:], len(unit)], strict=True)]


def _representatives() -> list[str]:
    """A lower-case character of each class, to write units of the training sample as text of the same classes."""
    out = ["?"] * LETTERS
    for c in [*range(0x200, 0xFF, -1), *range(0xFF, 0x2F, -1)]:
        if classes()[c] and chr(c).lower() == chr(c):
            out[classes()[c]] = chr(c)
    return out


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct units of each labelled document (three letters or more), and those only taken together (``plain`` 0)."""
    chars = _representatives()
    for batch in batches:
        for part, buf, off in blocks(batch, limit=1 << 19):
            runs = _runs(buf, off)
            letter, unit, first = letters_of(buf, off, runs)
            names = _spelled(letter, unit, chars)
            letter, unit, head = joined_of(buf, off, runs)
            joined = _spelled(letter, unit, chars)
            toxic, bag = part.column("toxic").to_pylist(), part.column("bag").to_pylist()
            rows = []
            for d in range(part.num_rows):
                own = set(names[first[d]:first[d + 1]])
                rows += [(bag[d], toxic[d], u, 1) for u in sorted(own) if len(u) >= 3]
                rows += [(bag[d], toxic[d], u, 0) for u in sorted(set(joined[head[d]:head[d + 1]]) - own) if len(u) >= 3]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.string(), pa.int32()))],
                                             ["bag", "toxic", "unit", "plain"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          toxic_rows: int = 3000, clean_rows: int = 9000, landmarks: int = 400, clean_units: int = 12_000, hard_units: int = 4000,
          bag_units: int = 25, rounds: int = 4, mining: int = 2) -> Model:
    """Fit on at most ``toxic_rows`` and ``clean_rows`` labelled documents (by hash of their ids), ``clean_units`` units of clean
    documents (half the most frequent, half by hash) and ``bag_units`` units of each toxic one. ``mining`` times, the
    ``hard_units`` units of clean documents with the highest margins join the negatives and the model is fitted again."""
    labels = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).filter(
        "doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    small_batches(docs.sparkSession)
    order = F.xxhash64("doc_id")
    sample = (labels.filter("toxic = 1").orderBy(order, "doc_id").limit(toxic_rows)
              .unionByName(labels.filter("toxic = 0").orderBy(order, "doc_id").limit(clean_rows)))
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id")
    source = source.select("text", "toxic", F.xxhash64("doc_id", "text").alias("bag")).persist()  # toxic_rows + clean_rows documents
    try:
        return _train_on(source, landmarks, clean_units, hard_units, bag_units, rounds, mining)
    finally:
        source.unpersist()
        release()  # the driver goes on with other work


def _train_on(source: DataFrame, landmarks: int, clean_units: int, hard_units: int, bag_units: int, rounds: int, mining: int) -> Model:
    """Fit on the sampled documents (text, toxic, bag)."""
    n = {r.toxic: r["count"] for r in source.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return Model(np.zeros(LETTERS ** 3, np.float32), 0.0, np.zeros(6), base=float(n.get(1, 0) > 0))
    both = source.mapInArrow(_bags, "bag long, toxic int, unit string, plain int").persist()
    bags = both.filter("plain = 1").drop("plain")
    seen = bags.groupBy("unit").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    lift = F.log((F.col("t") + 0.2) / n[1]) - F.log((F.col("c") + 1.0) / n[0])
    clean = seen.filter("c > 0 and t <= c")
    negatives = (clean.orderBy(F.desc("c"), "unit").limit(clean_units // 2).unionByName(clean.orderBy(F.xxhash64("unit"), "unit").limit(clean_units // 2))
                 .select("unit").distinct().collect())
    best = F.row_number().over(Window.partitionBy("bag").orderBy(F.desc("value"), "unit"))
    mine = (bags.filter("toxic = 1").join(seen.withColumn("lift", lift).filter("lift > 1"), "unit")
            .withColumn("value", F.col("lift") * F.log1p("t")).withColumn("place", best).filter(F.col("place") <= bag_units)
            .select("bag", "unit", "lift", "t").collect())
    all_clean = both.groupBy("unit").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).filter("c > 0 and t <= c")
    hard: dict[str, None] = {}
    model = _fit(negatives, [], mine, landmarks, rounds)
    for _ in range(mining):
        found = all_clean.select("unit").mapInArrow(_unit_margins(model), "unit string, margin double")
        hard.update(dict.fromkeys(r.unit for r in found.orderBy(F.desc("margin"), "unit").limit(hard_units).collect()))
        model = _fit(negatives, list(hard), mine, landmarks, rounds)
    rows = source.mapInArrow(_document_rows(model), "toxic int, x array<double>").collect()
    model.document = fit_logistic(np.array([r.x for r in rows]), np.array([float(r.toxic) for r in rows]))
    both.unpersist()
    return model


def _document_rows(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in blocks(batch, limit=1 << 19):
                x = _judged(buf, off, model)
                yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(list(x), pa.list_(pa.float64()))], ["toxic", "x"])
    return run


def _unit_margins(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in blocks(batch, "unit", 1 << 20):
                letter, unit, first = letters_of(buf, off)
                x, _ = _features(margins(letter, unit, model.weights, model.bias), first, limit=100.0)
                yield pa.RecordBatch.from_arrays([part.column("unit"), pa.array(x[:, 0])], ["unit", "margin"])
    return run


def _fit(negatives: list, hard: list[str], mine: list, landmarks: int, rounds: int) -> Model:
    units = sorted({r.unit for r in mine})
    place = {u: i for i, u in enumerate(units)}
    lift = np.zeros(len(units))
    times = np.zeros(len(units))
    for r in mine:
        lift[place[r.unit]], times[place[r.unit]] = r.lift, r.t
    clean = sorted({r.unit for r in negatives} | set(hard))
    bags: dict[int, list[int]] = {}
    for r in mine:
        bags.setdefault(r.bag, []).append(place[r.unit])
    positive = (lift > 2.5) & (times >= 3)
    if not positive.any() and len(units):
        positive[[max(b, key=lambda i: lift[i]) for b in bags.values()]] = True
    chosen = sorted(np.flatnonzero(positive), key=lambda i: (-lift[i] * np.log1p(times[i]), units[i]))[:landmarks // 2]
    marks = [units[i] for i in chosen]
    marks += sorted(set(hard) - set(marks), key=hash_of)[:landmarks // 4]
    marks += sorted(set(clean) - set(marks), key=hash_of)[:landmarks - len(marks)]
    square = kernel(marks, marks)
    value, vector = np.linalg.eigh((square + square.T) / 2)
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])
    x_clean, x_mine = kernel(clean, marks, root), kernel(units, marks, root)
    spoilt = kernel([v for i in chosen[:SPOILT] for v in with_insertions(units[i]) if len(units[i]) > 4], marks, root)
    w = np.zeros(root.shape[1] + 1)
    for _ in range(rounds):
        parts = [x_clean, x_mine[positive], spoilt]
        y = np.concatenate([-np.ones(len(clean)), np.ones(int(positive.sum()) + len(spoilt))])
        share = max(1.0, 0.2 * len(clean) / max(1, positive.sum()))
        weight = np.concatenate([np.ones(len(clean)), np.full(int(positive.sum()), share), np.full(len(spoilt), share / 10)])
        w = fit_svm(parts, y, weight)
        f = _values([x_mine], w)
        now = (f > 0) & (lift > 1.5)
        for b in bags.values():  # every toxic bag names its best unit, unless that is far on the clean side
            i = max(b, key=lambda k: (f[k], units[k]))
            now[i] |= f[i] > -0.5
        if (now == positive).all():
            break
        positive = now
    alpha = root @ w[:-1]
    table = np.zeros(LETTERS ** 3)
    who, what, weight = _subsequences(marks)
    np.add.at(table, what, weight * alpha[who])
    return Model(table.astype(np.float32), float(w[-1]), np.zeros(6), marks)


def with_insertions(u: str) -> list[str]:
    """``u`` with a letter put in at a third and at two thirds, as insults are spoilt to pass filters."""
    return [u[:k] + x + u[k:] for k, x in ((max(1, len(u) // 3), "x"), (max(1, 2 * len(u) // 3), "q"))]


def hash_of(u: str) -> int:
    """A fixed order of units that does not follow the alphabet."""
    out = 0
    for c in u:
        out = (out * 1_000_003 + ord(c)) & 0xFFFFFFFFFFFF
    return out * 0x9E3779B97F4A7C15 >> 7 & 0xFFFFFFFF
