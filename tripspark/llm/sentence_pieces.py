"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The automaton reads UTF-8 bytes (a space stands for the piece mark). Its edges are a hash table of a few MB; where a state has no
edge for a byte, its failure states are asked. At each position the pieces that end there come from the state's output links,
longest first, and relax the best score of the position; back pointers give the segmentation with the highest sum of piece scores, the longer piece on ties. A character without a
piece of its own may be spelled in byte pieces, at the lowest score less 10.

No piece holds a mark after another character, so a text falls into units (spaces and what follows them) whose best
segmentations are independent. Units of more than ``LONG`` bytes (text without spaces) are read by the automaton in stretches side by side and cut
further at positions that no piece spans. A task finds the distinct units of a block of texts and runs the Viterbi over all of them at once,
a position at a time, then copies the results to every place of the unit. Units that are still long are segmented in stretches side by side
too: first the best scores between all ways into and out of each stretch, then, with every stretch's true scores at its start, the same
Viterbi. Sums of scores are exact where scores are whole numbers; else scores that differ by rounding only count as ties. Nothing is shuffled.

Text is not normalised: one space is put in front, and decoding gives back every character. A piece mark that stands in the
text itself is spelled in bytes, so it returns too. Null gives null, the empty text no ids. Ids that are null, unknown or
control decode to nothing. Rows that repeat are encoded each; empty tables give empty results; other columns stay, but one that
has the result's name is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripspark.llm.common import blocks, distinct_spans, list_lengths, ranges, release, small_batches

MARK = "▁"
#: Bytes from which a unit is cut further or segmented in stretches, and the bytes of a stretch.
LONG, STRETCH = 1024, 256
#: Most stretches side by side.
_SIDE = 4096


@dataclass
class Automaton:
    """Edges by (state, byte), failure states, output state at or below each state and the next one below, and each output's piece."""

    edge: np.ndarray
    target: np.ndarray
    fail: np.ndarray
    out: np.ndarray
    below: np.ndarray
    piece: np.ndarray
    length: np.ndarray
    score: np.ndarray
    byte_ids: np.ndarray
    unknown: float
    alone: np.ndarray
    joined: bool
    table: np.ndarray
    table_start: np.ndarray
    table_size: np.ndarray


_BUILT: dict[str, Automaton] = {}


def automaton(model: bytes) -> Automaton:
    """The automaton of a serialized SentencePiece model; kept for the process."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _BUILT:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)]
        byte_ids = np.full(256, sp.unk_id(), np.int32)
        for i in range(n):
            if sp.is_byte(i):
                byte_ids[int(names[i][3:5], 16)] = i
        _BUILT[key] = build([x if p else None for x, p in zip(names, plain, strict=True)], [sp.get_score(i) for i in range(n)], byte_ids)
    return _BUILT[key]


def build(pieces: list[str | None], scores: list[float], byte_ids: np.ndarray) -> Automaton:
    """``pieces`` by id (None: never produced from text), their scores, and the ids of the 256 byte pieces."""
    raw = [b"" if p is None else p.replace(MARK, " ").encode() for p in pieces]
    child: list[dict[int, int]] = [{}]
    piece, length, score = [-1], [0], [0.0]
    for i, b in enumerate(raw):
        if not b:
            continue
        s = 0
        for x in b:
            if x not in child[s]:
                child[s][x] = len(child)
                child.append({})
                piece.append(-1)
                length.append(0)
                score.append(0.0)
            s = child[s][x]
        if piece[s] < 0:
            piece[s], length[s], score[s] = i, len(b), float(scores[i])
    states = len(child)
    fail, out, below = [0] * states, [0] * states, [0] * states
    queue = [0]
    for s in queue:  # breadth first: a state's failure state is done before it
        if s:
            below[s] = out[fail[s]]
            out[s] = s if piece[s] >= 0 else below[s]
        for x, t in child[s].items():
            f = fail[s]
            while f and x not in child[f]:
                f = fail[f]
            fail[t] = child[f].get(x, 0) if s else 0
            queue.append(t)
    edge, target = _edges(np.array([s << 8 | x for s in range(states) for x in child[s]], np.int64),
                          np.array([t for s in range(states) for t in child[s].values()], np.int32))
    # decoding: the bytes of every id
    spelled = list(raw)
    for x, i in enumerate(byte_ids.tolist()):
        if pieces[i] is None:
            spelled[i] = bytes([x]) if (byte_ids == i).sum() == 1 else b""
    size = np.array([len(b) for b in spelled], np.int64)
    used = np.zeros(256, bool)
    used[np.frombuffer(b"".join(raw), np.uint8)] = True
    lowest = min((s for s, b in zip(scores, raw, strict=True) if b), default=0.0)
    return Automaton(edge, target, np.array(fail, np.int32), np.array(out, np.int32), np.array(below, np.int32), np.array(piece, np.int32), np.array(length, np.int64), np.array(score), byte_ids.astype(np.int32),
                     lowest - 10.0, ~used, any(b" " in b.lstrip(b" ") for b in raw),
                     np.frombuffer(b"".join(spelled), np.uint8), np.cumsum(size) - size, size)


def _place(key: np.ndarray, probe, size: int) -> np.ndarray:
    return ((key * 0x9E3779B1 >> 7) + probe) & (size - 1)


def _edges(key: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash table of edges with open places (-1): at most a quarter full, a taken place means the next one."""
    size = 1 << max(4, int(4 * len(key)).bit_length())
    table, to = np.full(size, -1, np.int64), np.zeros(size, np.int32)
    probe = 0
    while len(key):
        at = _place(key, probe, size)
        free = table[at] < 0
        table[at[free]] = key[free]
        mine = table[at] == key
        to[at[mine]] = target[mine]
        key, target, probe = key[~mine], target[~mine], probe + 1
    return table, to


def _follow(a: Automaton, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """The states after reading ``byte``: along an edge, else along the failure states' edges, else the root."""
    out = np.zeros(len(state), np.int32)
    todo, probe = np.arange(len(state)), np.zeros(len(state), np.int64)
    key = state.astype(np.int64) << 8 | byte
    while len(todo):
        at = _place(key, probe, len(a.edge))
        there = a.edge[at]
        found = there == key
        out[todo[found]] = a.target[at[found]]
        taken = (there >= 0) & ~found  # another edge has the place: the next one
        rest = taken | ((there < 0) & (key >= 256))  # no edge of this state: its failure state's
        todo, key, taken, probe = todo[rest], key[rest], taken[rest], probe[rest]
        key = np.where(taken, key, a.fail[key >> 8].astype(np.int64) << 8 | (key & 255))
        probe = np.where(taken, probe + 1, 0)
    return out


def viterbi(a: Automaton, buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the units buf[start:start+size], one after another, and how many each has."""
    order = np.argsort(-size, kind="stable")
    ids, unit, place = [], [], []
    at = 0
    long = int((size > LONG).sum())
    if long:
        _best_long(a, buf, start[order[:long]], size[order[:long]], order[:long], ids, unit, place)
        at = long
    while at < len(order):
        longest = int(size[order[at]])
        to = at + max(1, min(len(order) - at, (1 << 19) // max(longest, 1)))
        _best(a, buf, start[order[at:to]], size[order[at:to]], order[at:to], ids, unit, place)
        at = to
    if not ids:
        return np.zeros(0, np.int32), np.zeros(len(size), np.int64)
    ids, unit, place = np.concatenate(ids), np.concatenate(unit), np.concatenate(place)
    by = np.lexsort((place, unit))
    return ids[by], np.bincount(unit, minlength=len(size))


def _best(a: Automaton, buf, start, size, name, ids, unit, place) -> None:
    n, longest = len(start), int(size[0])
    best = np.full((longest + 1, n), -np.inf)
    best[0] = 0.0
    back, step = np.full((longest + 1, n), -1, np.int32), np.zeros((longest + 1, n), np.int32)
    state, char = np.zeros(n, np.int32), np.zeros(n, np.int64)  # char: bytes of the character so far
    for t in range(longest):
        live = int(np.searchsorted(-size, -t))  # units longer than t stand first
        byte = buf[start[:live] + t]
        state = _follow(a, state[:live], byte)
        char = np.where((byte & 0xC0) == 0x80, char[:live] + 1, 1)
        top, single = np.full(live, -np.inf), np.zeros(live, bool)
        rows, link = np.arange(live), a.out[state]
        rows, link = rows[link > 0], link[link > 0]
        while len(rows):
            long = a.length[link]
            score = best[t + 1 - long, rows] + a.score[link]
            single[rows] |= long == char[rows]
            better = score > top[rows]
            r, k = rows[better], link[better]
            top[r], back[t + 1, r], step[t + 1, r] = score[better], a.piece[k], a.length[k]
            link = a.below[link]
            rows, link = rows[link > 0], link[link > 0]
        following = buf[np.minimum(start[:live] + t + 1, len(buf) - 1)]
        closed = (size[:live] == t + 1) | ((following & 0xC0) != 0x80)
        spell = np.flatnonzero(closed & ~single)
        score = best[t + 1 - char[spell], spell] + a.unknown
        better = score > top[spell]
        r = spell[better]
        top[r], back[t + 1, r], step[t + 1, r] = score[better], -1, char[r]
        best[t + 1, :live] = top
    rows, pos = np.arange(n), size.astype(np.int64).copy()
    while len(rows):
        piece, long = back[pos, rows], step[pos, rows].astype(np.int64)
        pos = pos - long
        known = piece >= 0
        ids.append(piece[known])
        unit.append(name[rows[known]])
        place.append(pos[known])
        long = long[~known]
        spelled = ranges(start[rows[~known]] + pos[~known], long)
        ids.append(a.byte_ids[buf[spelled]])
        unit.append(np.repeat(name[rows[~known]], long))
        place.append(spelled - np.repeat(start[rows[~known]], long))
        rows, pos = rows[pos > 0], pos[pos > 0]


def _reach(a: Automaton) -> int:
    """Bytes of the longest piece or character."""
    return max(4, int(a.length.max()))


def _stretches(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of the stretches of each span (the last one longest), and which stretches begin a span."""
    count = np.maximum((end - start) // STRETCH, 1)
    begin = np.repeat(start, count) + ranges(np.zeros(len(count), np.int64), count) * STRETCH
    first = np.zeros(len(begin), bool)
    first[np.cumsum(count) - count] = True
    stop = begin + STRETCH
    stop[np.cumsum(count) - 1] = end
    return begin, stop, first


def _nodes(a: Automaton, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The automaton's state after each byte of the spans buf[start:end] (0 elsewhere). A state depends on no more bytes than the
    longest piece has, so each stretch is read from so many bytes before it, if the span has them."""
    out = np.zeros(len(buf), np.int32)
    own, stop, first = _stretches(start, end)
    begin = np.maximum(np.where(first, own, own - _reach(a)), np.repeat(start, np.diff(np.append(np.flatnonzero(first), len(first)))))
    order = np.argsort(begin - stop, kind="stable")
    begin, own, stop = begin[order], own[order], stop[order]
    state, size = np.zeros(len(begin), np.int32), stop - begin
    for t in range(int(size[0])):
        live = int(np.searchsorted(-size, -t))
        at = begin[:live] + t
        state = _follow(a, state[:live], buf[at])
        mine = at >= own[:live]
        out[at[mine]] = state[mine]
    return out


def _cuts(a: Automaton, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Positions inside the spans that start a character and that no piece spans."""
    link = a.out[_nodes(a, buf, start, end)]
    stop = np.flatnonzero(link > 0) + 1
    spanned = np.zeros(len(buf) + 2, np.int32)
    np.add.at(spanned, stop - a.length[link[stop - 1]] + 1, 1)  # the longest piece that ends here covers what the others do
    np.add.at(spanned, stop, -1)
    inside = np.zeros(len(buf) + 1, np.int8)
    inside[start + 1] += 1
    inside[end] -= 1
    free = (np.cumsum(spanned[:len(buf)], dtype=np.int32) == 0) & (np.cumsum(inside[:len(buf)], dtype=np.int8) > 0)
    return np.flatnonzero(free & ((buf & 0xC0) != 0x80))


def _sweep(a: Automaton, buf, node, spelled, begin, stop, front, trace=None) -> np.ndarray:
    """Viterbi over stretches side by side, longest first. ``front``: best scores (ways x stretches x columns) 0, 1, ... bytes before each begin;
    returned are those before each end. ``trace``: arrays by byte that take the last piece (-1: spelled) and its bytes."""
    reach = len(front)
    m = reach + 1
    best = np.full((m, *front.shape[1:]), -np.inf)
    best[-np.arange(reach) % m] = front
    size = stop - begin
    for t in range(int(size[0])):
        live = int(np.searchsorted(-size, -t))
        at = begin[:live] + t
        top = np.full((live, front.shape[2]), -np.inf)

        def relax(rows, long, score, piece):
            new = best[(t + 1 - long) % m, rows] + score[:, None]  # noqa: B023
            old = top[rows]  # noqa: B023
            top[rows] = np.maximum(new, old)  # noqa: B023
            if trace is not None:
                r = new[:, 0] > old[:, 0]
                where = at[rows[r]]  # noqa: B023
                trace[0][where], trace[1][where] = piece[r], long[r]

        link = a.out[node[at]]
        rows = np.flatnonzero(link)
        link = link[rows]
        while len(rows):
            relax(rows, a.length[link], a.score[link], a.piece[link])
            link = a.below[link]
            rows, link = rows[link > 0], link[link > 0]
        rows = np.flatnonzero(spelled[at])
        if len(rows):
            relax(rows, spelled[at[rows]].astype(np.int64), np.full(len(rows), a.unknown), np.full(len(rows), -1))
        best[(t + 1) % m, :live] = top
    return best[(size[None, :] - np.arange(reach)[:, None]) % m, np.arange(len(size))[None, :]]


def _spelled(a: Automaton, buf: np.ndarray, node: np.ndarray) -> np.ndarray:
    """At the last byte of each character that is no piece by itself, the character's bytes; else 0."""
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    last = np.append(lead[1:], len(buf)) - 1
    size = last - lead + 1
    link, single = a.out[node[last]], np.zeros(len(last), bool)
    rows = np.flatnonzero(link)
    while len(rows):
        single[rows] |= a.length[link[rows]] == size[rows]
        link[rows] = a.below[link[rows]]
        rows = rows[link[rows] > 0]
    out = np.zeros(len(buf), np.int8)
    out[last[~single]] = size[~single]
    return out


def _best_long(a: Automaton, buf, start, size, name, ids, unit, place) -> None:
    """Segment long units: every stretch gets the best scores at its start, from the ones before, then its own last pieces."""
    end = start + size
    node, reach = _nodes(a, buf, start, end), _reach(a)
    spelled = _spelled(a, buf, node)
    last, bytes_of = np.zeros(len(buf), np.int32), np.zeros(len(buf), np.int32)
    begin, stop, first = _stretches(start, end)
    fresh = np.full(reach, -np.inf)
    fresh[0] = 0.0
    ways = np.where(np.eye(reach, dtype=bool), 0.0, -np.inf)[:, None, :]
    score = fresh
    for at in range(0, len(begin), _SIDE):
        order = at + np.argsort(begin[at:at + _SIDE] - stop[at:at + _SIDE], kind="stable")
        b, e = begin[order], stop[order]
        through = _sweep(a, buf, node, spelled, b, e, np.repeat(ways, len(order), 1))  # way out x stretch x way in
        front, back = np.empty((reach, len(order), 1)), np.argsort(order)
        for k in range(len(order)):
            score = fresh if first[at + k] else score
            front[:, back[k], 0] = score
            score = (through[:, back[k], :] + score).max(axis=1)
        _sweep(a, buf, node, spelled, b, e, front, (last, bytes_of))
    step = memoryview(bytes_of)
    for s, e, u in zip(start.tolist(), end.tolist(), name.tolist(), strict=True):
        ends, p = [], e
        while p > s:
            ends.append(p)
            p -= step[p - 1]
        ends = np.array(ends, np.int64) - 1
        known = last[ends] >= 0
        ids.append(last[ends[known]])
        place.append(ends[known] + 1 - bytes_of[ends[known]] - s)
        raw = ranges(ends[~known] + 1 - bytes_of[ends[~known]], bytes_of[ends[~known]].astype(np.int64))
        ids.append(a.byte_ids[buf[raw]])
        place.append(raw - s)
        unit.append(np.full(len(ends[known]) + len(raw), u))


def units(a: Automaton, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where units start: at a text, at a space after another byte, around bytes that no piece has, and in long ones wherever no piece spans."""
    new = np.zeros(len(buf), bool)
    new[off[:-1][off[:-1] < off[1:]]] = True
    if not a.joined:
        new[1:] |= (buf[1:] == 0x20) & (buf[:-1] != 0x20)
        ascii_alone = a.alone & (np.arange(256) < 0x80)
        single = ascii_alone[buf]
        new |= single
        new[1:] |= single[:-1] & ((buf[1:] & 0xC0) != 0x80)
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(buf))
    long = end - start > LONG
    return np.sort(np.concatenate((start, _cuts(a, buf, start[long], end[long])))) if long.any() else start


def encode_block(a: Automaton, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a block and the number of each text's ids."""
    texts = len(off) - 1
    some = off[1:] > off[:-1]
    # one space in front of every text that is not empty
    spaced = np.full(len(buf) + int(some.sum()), 0x20, np.uint8)
    shift = np.cumsum(some)
    spaced[np.arange(len(buf)) + np.repeat(shift, np.diff(off))] = buf
    off = off + np.concatenate(([0], shift))
    start = units(a, spaced, off)
    size = np.diff(np.append(start, len(spaced)))
    first, same = distinct_spans(spaced, start, size)
    ids, count = viterbi(a, spaced, start[first], size[first])
    each = count[same]
    text = np.searchsorted(off, start, "right") - 1
    return ids[ranges((np.cumsum(count) - count)[same], each)], np.bincount(text, each, texts).astype(np.int64)


def decode_ids(a: Automaton, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts of ``ids`` (``counts`` for each text) and their offsets; the space in front is dropped."""
    ids = np.where((ids >= 0) & (ids < len(a.table_size)), ids, 0)
    size = a.table_size[ids]
    data = a.table[ranges(a.table_start[ids], size)]
    ends = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(counts)))]
    lead = ends[:-1][ends[:-1] < ends[1:]]
    lead = lead[data[lead] == 0x20]
    keep = np.ones(len(data), bool)
    keep[lead] = False
    return data[keep], ends - np.searchsorted(lead, ends)


def _apply(model: bytes, source: str, target: str, work):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(model)
        for batch in batches:
            yield from work(a, batch, source, target)
        release()
    return run


def _encode(a: Automaton, batch: pa.RecordBatch, source: str, target: str) -> Iterator[pa.RecordBatch]:
    for part, buf, off in blocks(batch, source):
        ids, count = encode_block(a, buf, off)
        null = part.column(source).is_null().to_numpy(zero_copy_only=False)
        offsets = pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32(), mask=np.append(null, False))
        yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))], [*part.schema.names, target])


def _decode(a: Automaton, batch: pa.RecordBatch, source: str, target: str) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, 1000):
        part = batch.slice(at, 1000)
        lists = part.column(source)
        counts, flat = list_lengths(lists)
        data, off = decode_ids(a, flat.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), counts)
        null = lists.is_null().to_numpy(zero_copy_only=False)
        texts = [None if null[i] else data[off[i]:off[i + 1]].tobytes().decode("utf-8", "replace") for i in range(len(lists))]
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, target])


def _with(df: DataFrame, model: bytes, source: str, target: str, kind: T.DataType, work) -> DataFrame:
    df = df.drop(target)
    small_batches(df.sparkSession)
    return df.mapInArrow(_apply(model, source, target, work), T.StructType([*df.schema.fields, T.StructField(target, kind)]))


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(df: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with the ids of ``text_col``; ``model`` is a serialized SentencePiece model."""
    return _with(df, model, text_col, ids_col, T.ArrayType(T.IntegerType()), _encode)


def decode(df: DataFrame, model: bytes, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids_col``."""
    return _with(df, model, ids_col, text_col, T.StringType(), _decode)


def round_trip(df: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """``df`` with ids, and whether decoding them gives the text back (null: equals null)."""
    return decode(encode(df, model, text_col), model).withColumn("exact", F.col("decoded").eqNullSafe(F.col(text_col))).drop("decoded")
