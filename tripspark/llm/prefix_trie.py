"""Conversation prefix trie with balanced subtree totals by centroid decomposition of the parent edges.

A node is a distinct sequence of first turns (role, text); the root is the empty sequence. ``numbered`` gives every turn its place and
``nodes`` every prefix its key. Both sort the turns by range over all tasks, so one conversation may span many of them; a task
scans its part, and the few parts that continue a conversation are corrected from the parts before. A prefix's key
is a polynomial hash of its turns' SHA-256 digests modulo 2**127 - 1, which can be continued from the hash of what stands before.

``totals`` sums values over subtrees. A component is a connected piece of the tree; it is weighted by the turns of its members, and
its centroid is the deepest node that holds half of the weight at or below it. What lies at and below the centroid is
totalled and added to each node from the centroid up to the component's top; without the centroid the component falls into pieces of at
most half its weight, which are split in the same way. So every pair of a node and one of its descendants is counted once, when a centroid
parts them, after at most log2(weight) rounds, however deep or wide the tree is. Components above ``most`` turns are split by Spark
joins (a node's ancestor at a depth is looked up in the path of its least member); the smaller ones are dealt to tasks, which
split all of theirs at once in numpy.

Rows without a conversation id are left out. Turns come in the order turn (null first), role, text; null roles and texts are
empty; rows that repeat are turns each. Ids are whole numbers. Empty tables give no node, not even the root. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.llm.common import join_counted, small_batches, stored
from tripspark.llm.graph import whole_groups

#: Modulus and base of the prefix hashes.
PRIME, BASE = (1 << 127) - 1, 0x5D2A9F3C71E84B06A3C5D7E91B2F4861
ROOT = "0" * 32
#: Turns of a component that a task splits by itself, by default.
MOST = 50_000
#: Ids joined in one row before they are hashed.
PACK = 50_000


# --------------------------------------------------------------------------- places and prefix hashes of sorted turns

def _digest(role: bytes, text: bytes) -> str:
    return hashlib.sha256(b"%d:%b%b" % (len(role), role, text)).hexdigest()[:32]


def _scan(names: list[str], hashes: bool):
    """Pass over sorted turns: each one's place in its conversation and, with ``hashes``, the hash up to and before it, both as
    far as the task sees. Rows with ``edge`` give the task's first and last conversation as a whole (one if they are the same)."""
    def batch_of(part: int, conv, place, edge: bool, node, parent, columns) -> pa.RecordBatch:
        n = len(place)
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * n, pa.int32()), pa.array(conv, pa.int64()), pa.array(place, pa.int64()), pa.array([edge] * n, pa.bool_()),
             pa.array(node, pa.string()), pa.array(parent, pa.string()), *columns], ["part", "conv", "place", "edge", "node", "parent", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, place, value, runs, kinds = None, 0, 0, [], None
        for batch in batches:
            columns = [batch.column(c) for c in names]
            kinds = [c.type for c in columns]
            places, nodes, parents = [], [], []
            digests = batch.column("digest").to_pylist()
            for conv, digest in zip(batch.column("conv").to_pylist(), digests, strict=True):
                if conv != last:
                    if last is not None and not runs:
                        runs.append((last, place, value))
                    last, place, value = conv, 0, 0
                place += 1
                places.append(place)
                if hashes:
                    parents.append(f"{value:032x}")
                    value = (value * BASE + int(digest, 16)) % PRIME
                    nodes.append(f"{value:032x}")
            empty = [None] * len(places)
            yield batch_of(part, batch.column("conv"), places, False, nodes or empty, parents or empty, columns)
        if last is not None:
            runs.append((last, place, value))
            yield batch_of(part, [r[0] for r in runs], [r[1] for r in runs], True, [f"{r[2]:032x}" for r in runs], [None] * len(runs),
                           [pa.nulls(len(runs), k) for k in kinds])
    return run


def _before(table: pa.Table) -> pa.Table:
    """Of one conversation's pieces: what stands before each (none for the first)."""
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    out, place, value = [], 0, 0
    for r in rows:
        if place:
            out.append((r["conv"], r["part"], place, f"{value:032x}"))
        place += r["place"]
        value = (value * pow(BASE, r["place"], PRIME) + int(r["node"], 16)) % PRIME
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string())
    return pa.Table.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["conv", "part", "n", "h"])


def _continued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of rows whose conversation began in an earlier part."""
    for batch in batches:
        at = batch.schema.get_field_index
        nodes, parents = [], []
        for place, n, h, node, parent in zip(*(batch.column(c).to_pylist() for c in ("place", "n", "h", "node", "parent")), strict=True):
            before = int(h, 16) * pow(BASE, place - n - 1, PRIME)
            nodes.append(f"{(before * BASE + int(node, 16)) % PRIME:032x}")
            parents.append(f"{(before + int(parent, 16)) % PRIME:032x}")
        yield batch.set_column(at("node"), "node", pa.array(nodes, pa.string())).set_column(at("parent"), "parent", pa.array(parents, pa.string()))


def _scanned(spark: SparkSession, turns: DataFrame, names: str, hashes: bool) -> DataFrame:
    """``turns`` (conv, digest and the carried columns ``names``), sorted over all tasks, with place, node and parent."""
    carried = [c.split()[0] for c in names.split(", ")]
    schema = "part int, conv long, place long, edge boolean, node string, parent string, " + names
    out = stored(spark, turns.mapInArrow(_scan(carried, hashes), schema), "scan")
    # two rows of each task at most
    pieces = out.filter("edge").select("conv", "part", "place", "node")
    before = stored(spark, pieces.groupBy("conv").applyInArrow(_before, "conv long, part int, n long, h string"), "before")
    rows = out.filter("not edge").drop("edge").join(F.broadcast(before), ["conv", "part"], "left")
    rows = rows.withColumn("place", F.col("place") + F.coalesce("n", F.lit(0)))
    if hashes:
        later = rows.filter("n is not null")
        rows = rows.filter("n is null").unionByName(later.mapInArrow(_continued, later.schema))
    return rows.drop("part", "n", "h")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        role, text = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("role", "text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), pa.array([_digest(r, t) for r, t in zip(role, text, strict=True)], pa.string()),
             pa.array([len(t) for t in text], pa.int64())], ["conv", "digest", "bytes"])


def numbered(rows: DataFrame) -> DataFrame:
    """(conv, place, digest, bytes) of every turn of ``rows`` (conv_id, turn, role, text)."""
    spark = small_batches(rows.sparkSession)
    said = rows.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    sorted_ = said.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_digests, "conv long, digest string, bytes long")
    return _scanned(spark, sorted_, "digest string, bytes long", False).select("conv", "place", "digest", "bytes")


def whole(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: (conv, len), and turns (conv, depth, len, digest, bytes)."""
    spark = turns.sparkSession
    turns = stored(spark, turns, "numbered")
    convs = stored(spark, turns.groupBy("conv").agg(F.count("*").alias("len")), "convs")
    return convs, join_counted(turns.withColumnRenamed("place", "depth"), convs, "conv", "len", "depth")


def with_shared_heads(turns: DataFrame, group: int, head: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt from shared heads: of the first of each ``group`` ids (c - c % group) the first ``head`` turns (an expression
    of ``conv``, below 16; fewer if it has fewer), then the conversation's own after its first ``head``. Returns what ``whole`` does."""
    spark = turns.sparkSession
    turns = stored(spark, turns, "numbered")
    own = stored(spark, turns.groupBy("conv").agg(F.count("*").alias("n")).select(
        "conv", "n", (F.col("conv") - F.col("conv") % group).alias("base"), head.cast("long").alias("head")), "own")
    bases = own.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = own.join(bases, "base", "left").withColumn("shared", F.least("head", F.coalesce("base_n", F.lit(0)))).withColumn(
        "len", F.col("shared") + F.greatest(F.col("n") - F.col("head"), F.lit(0)))
    convs = stored(spark, convs.select("conv", "base", "n", "head", "shared", "len"), "convs")
    firsts = turns.filter("place < 16").withColumnRenamed("conv", "base")  # of a conversation: fifteen rows, for ``group`` others
    heads = (convs.filter("shared > 0").select("conv", "base", "shared", "len").join(firsts, "base").filter("place <= shared")
             .select("conv", F.col("place").alias("depth"), "len", "digest", "bytes"))
    rest = join_counted(turns, convs.select("conv", "n", "head", "shared", "len"), "conv", "n", "place").filter("place > head").select(
        "conv", (F.col("place") - F.col("head") + F.col("shared")).alias("depth"), "len", "digest", "bytes")
    return convs.select("conv", "len"), heads.unionByName(rest)


# --------------------------------------------------------------------------- nodes

def nodes(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored nodes and steps of the trie over ``convs`` (conv, len) and their ``turns`` (conv, depth, len, digest, bytes).

    Nodes: node, parent, depth, conv (least member), n_convs, weight (turns of its members from here on), bytes (of the last turn), n_children.
    Steps: conv, depth, len, node, parent for every turn of every conversation.
    """
    spark = turns.sparkSession
    by_range = turns.repartitionByRange("conv", "depth").sortWithinPartitions("conv", "depth")
    steps = stored(spark, _scanned(spark, by_range, "depth long, len long, bytes long", True).drop("place"), "steps")
    members = steps.groupBy("node", "parent", "depth", "bytes").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.sum(F.col("len") - F.col("depth") + 1).alias("weight"))
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.sum(F.col("len") + 1).alias("weight")).filter("n_convs > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"),
        "conv", "n_convs", "weight")
    found = stored(spark, members.unionByName(root), "nodes")
    children = found.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    return stored(spark, found.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie"), steps


# --------------------------------------------------------------------------- subtree totals

def split_all(parent: np.ndarray, depth: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree totals of ``values`` (nodes x columns) in a forest, all components split at their centroids at once.

    ``parent``: index, -1 for a top; ``weight``: above 0 and of a node at least the sum of its children's, plus something.
    """
    n = len(parent)
    parent, weight, out = parent.copy(), weight.copy(), np.zeros_like(values)
    alive = np.arange(n)
    top = _tops(parent, alive)
    while len(alive):
        half = alive[2 * weight[alive] >= weight[top[alive]]]
        half = half[np.lexsort((depth[half], top[half]))]
        centre = half[np.append(top[half][1:] != top[half][:-1], True)]
        first = np.flatnonzero(np.isin(parent[alive], centre))  # tops of the pieces below
        under, was = alive[first], parent[alive[first]]
        old = parent.copy()
        parent[under] = -1
        gone = np.zeros(n, bool)
        gone[centre] = True
        alive = alive[~gone[alive]]
        top = _tops(parent, alive)
        total = np.zeros_like(values)
        np.add.at(total, top[alive], values[alive])
        part = np.zeros_like(values)
        part[centre] = values[centre]
        np.add.at(part, was, total[under])
        part, less, at = part[centre], weight[centre], centre
        while len(at):  # from each centroid to the top of its component
            out[at] += part
            weight[at] -= less
            at = old[at]
            on = at >= 0
            part, less, at = part[on], less[on], at[on]
    return out


def _tops(parent: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """The top of each living node's component, by doubled pointers."""
    up = np.arange(len(parent))
    has = alive[parent[alive] >= 0]
    up[has] = parent[has]
    while True:
        further = up[up]
        if (further == up).all():
            return up
        up = further


def _split_small(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in whole_groups(batches, ["comp"]):
            node, above = batch.column("node"), batch.column("parent")
            parent = pc.index_in(above, node).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            same = batch.column("comp").to_numpy(zero_copy_only=False)
            parent[(parent >= 0) & (same[parent] != same)] = -1
            values = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns]).astype(np.int64)
            out = split_all(parent, batch.column("depth").to_numpy(), batch.column("weight").to_numpy(), values)
            yield pa.RecordBatch.from_arrays([node, *(pa.array(out[:, k]) for k in range(len(columns)))], ["node", *columns])
    return run


def _step_key(conv, depth) -> Column:
    return F.concat_ws(":", conv, depth)


def _split_large(spark: SparkSession, large: DataFrame, steps: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """One round over ``large``: what to add to nodes (node, columns), and the pieces left (with their new comp and weights)."""
    chosen = F.when(2 * F.col("weight") >= F.col("total"), F.struct("depth", "node", F.col("conv").alias("member"), "weight"))
    centres = stored(spark, large.groupBy("comp").agg(F.count("*").alias("n"), F.min("depth").alias("top_depth"), F.max(chosen).alias("c")).select(
        "comp", "n", "top_depth", F.col("c.depth").alias("c_depth"), F.col("c.node").alias("c"), F.col("c.member").alias("c_member"), F.col("c.weight").alias("c_weight")), "centres")
    near = stored(spark, join_counted(large.drop("total"), centres.select("comp", "n", "c", "c_depth", "c_weight"), "comp", "n", "spread").drop("n"), "near")
    # of a node further down: its ancestor one step below the centroid's depth, and that one's parent
    deep = near.filter("depth > c_depth").withColumn("key", _step_key(F.col("conv"), F.col("c_depth") + 1))
    asked = deep.groupBy("key").agg(F.count("*").alias("n"))
    path = steps.select(_step_key(F.col("conv"), F.col("depth")).alias("key"), F.col("node").alias("piece"), F.col("parent").alias("hangs_on"))
    deep = join_counted(deep, stored(spark, asked.join(path, "key"), "asked"), "key", "n", "spread").drop("key", "n")
    rest = near.filter("depth <= c_depth").withColumn("piece", F.lit(None).cast("string")).withColumn("hangs_on", F.lit(None).cast("string"))
    near = deep.unionByName(rest).withColumn("below", F.coalesce(F.col("hangs_on") == F.col("c"), F.lit(False)))
    near = stored(spark, near, "parted")
    totals = near.filter("below or node = c").groupBy("comp").agg(*(F.sum(c).alias(c) for c in columns))
    totals = centres.join(totals, "comp")
    upwards = totals.join(steps.select("conv", "depth", "parent"), (F.col("conv") == F.col("c_member")) & (F.col("depth") > F.col("top_depth")) & (F.col("depth") <= F.col("c_depth")))
    added = stored(spark, upwards.select(F.col("parent").alias("node"), "c_weight", *columns).unionByName(totals.select(F.col("c").alias("node"), "c_weight", *columns)), "added")
    left = near.filter("node <> c").drop("c_weight").join(added.select("node", "c_weight"), "node", "left")
    left = left.withColumn("weight", F.col("weight") - F.coalesce("c_weight", F.lit(0))).withColumn("comp", F.when(F.col("below"), F.col("piece")).otherwise(F.col("comp")))
    left = left.drop("c", "c_depth", "c_weight", "piece", "hangs_on", "below")
    return added.drop("c_weight"), stored(spark, left, "pieces")


def totals(trie: DataFrame, steps: DataFrame, columns: list[str], most: int = MOST) -> DataFrame:
    """(node, columns): subtree sums of the long ``columns`` of ``trie``."""
    spark = trie.sparkSession
    kinds = "node string, " + ", ".join(f"{c} long" for c in columns)
    left = trie.select("node", "parent", "depth", "conv", "weight", *columns, F.xxhash64("node").alias("spread"), F.lit(ROOT).alias("comp"))
    parts: list[DataFrame] = []
    small: list[DataFrame] = []
    while True:
        sizes = stored(spark, left.groupBy("comp").agg(F.count("*").alias("n"), F.max("weight").alias("total")), "sizes")
        left = stored(spark, join_counted(left, sizes, "comp", "n", "spread").drop("n"), "sized")
        small.append(left.filter(F.col("total") <= most).drop("total"))
        large = left.filter(F.col("total") > most)
        if large.isEmpty():
            break
        added, left = _split_large(spark, large, steps, columns)
        parts.append(added)
    rest = small[0]
    for x in small[1:]:
        rest = rest.unionByName(x)
    parts.append(rest.repartition("comp").sortWithinPartitions("comp").mapInArrow(_split_small(columns), kinds))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.groupBy("node").agg(*(F.sum(c).alias(c) for c in columns))


# --------------------------------------------------------------------------- members that end at a node

def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv) as rows of joined ids of one node."""
    def out(node, ids):
        return pa.RecordBatch.from_arrays([pa.array([node]), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["node", "first", "ids"])

    node, ids = None, []
    for batch in batches:
        for x, conv in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist(), strict=True):
            if ids and (x != node or len(ids) >= PACK):
                yield out(node, ids)
                ids = []
            node = x
            ids.append(conv)
    if ids:
        yield out(node, ids)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's joined ids; rows sorted by node and first id."""
    def out(node, sha):
        return pa.RecordBatch.from_arrays([pa.array([node]), pa.array([sha.hexdigest()])], ["node", "ends_sha256"])

    node, sha = None, None
    for batch in batches:
        for x, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if x == node:
                sha.update(b",")
            else:
                if sha is not None:
                    yield out(node, sha)
                node, sha = x, hashlib.sha256()
            sha.update(ids.encode())
    if sha is not None:
        yield out(node, sha)


def ends(convs: DataFrame, steps: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the ids, ascending and joined by commas, of the conversations that end at a node.

    The ids of a node are packed where they lie after a sort by range, so the task that hashes them gets a row for each ``PACK`` of them.
    """
    last = steps.filter("depth = len").select("node", "conv").unionByName(convs.filter("len = 0").select(F.lit(ROOT).alias("node"), "conv"))
    packed = last.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv").mapInArrow(_packed, "node string, first long, ids string")
    return packed.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_hashed, "node string, ends_sha256 string")


def summary(convs: DataFrame, turns: DataFrame, most: int = MOST) -> DataFrame:
    """One row a node: node, conv_id, depth, parent, parent_conv_id, n_convs, n_children, n_leaves, saved_bytes, ends_sha256.

    ``n_leaves`` and ``saved_bytes`` are totals over the node's subtree: of nodes without children, and of (n_convs - 1) * UTF-8 bytes of the
    last text, which is what storing each shared turn once saves.
    """
    trie, steps = nodes(convs, turns)
    own = trie.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved_bytes", (F.col("n_convs") - 1) * F.col("bytes"))
    sums = totals(own, steps, ["n_leaves", "saved_bytes"], most)
    parents = trie.filter("n_children > 0").select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"), "n_children")
    below = trie.filter("parent is not null").select("node", "parent", F.xxhash64("node").alias("spread"))
    above = join_counted(below, parents, "parent", "n_children", "spread").select("node", "parent_conv_id")
    return (trie.join(sums, "node").join(above, "node", "left").join(ends(convs, steps), "node", "left")
            .select("node", F.col("conv").alias("conv_id"), "depth", "parent", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_bytes",
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


def build(rows: DataFrame, most: int = MOST) -> DataFrame:
    """``summary`` of the conversations ``rows`` (conv_id, turn, role, text) as they are."""
    return summary(*whole(numbered(rows)), most)
