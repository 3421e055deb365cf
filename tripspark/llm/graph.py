"""Helpers for jobs on sorted groups and on links: groups across Arrow batches, pairs, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.llm.common import stored


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 20_000, size: int = 64 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of complete groups (the partition is sorted by ``keys``, long columns), and where each group starts.

    Holds about ``rows`` rows or ``size`` bytes, or one group.
    """
    held: list[pa.RecordBatch] = []
    n = total = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n, total = n + batch.num_rows, total + batch.nbytes
        if n >= rows or total >= size:
            one = _joined(held)
            new = _starts(one, keys)
            cut = int(new[-1])
            if cut:
                yield one.slice(0, cut), new[:-1]
            held = [one.slice(cut)]
            n, total = one.num_rows - cut, (0 if cut else total // 2)
    if n:
        one = _joined(held)
        yield one, _starts(one, keys)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for k in keys:
        v = batch.column(k).to_numpy(zero_copy_only=False)
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def block_pairs(df: DataFrame, group: str, size: str, member: str, most: int) -> DataFrame:
    """Deal each group to pairs of blocks (lo, hi) of about ``most`` rows: columns lo, hi, block are added.

    Every two members of a group meet in exactly one pair of blocks. A group of up to ``most`` rows is one block.
    """
    blocks = F.ceil(F.col(size) / F.lit(most)).cast("int")
    mine = F.pmod(F.xxhash64(F.col(member), F.col(group)), blocks).cast("int")
    return (df.withColumn("block", mine).withColumn("__with", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("lo", F.least("block", "__with")).withColumn("hi", F.greatest("block", "__with")).drop("__with"))


def pairs_in_groups(start: np.ndarray, n: int, block: np.ndarray, lo: np.ndarray, hi: np.ndarray,
                    at_once: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (a, b), a before b, of groups sorted by block: all pairs of one block, or those across two."""
    end = np.repeat(np.append(start[1:], n), np.diff(np.append(start, n)))
    row = np.arange(n)
    group = np.repeat(np.arange(len(start)), np.diff(np.append(start, n)))
    across = lo != hi
    first_hi = np.minimum.reduceat(np.where(across & (block == hi), row, n), start) if n else row
    frm = np.where(across, np.where(block == lo, np.minimum(first_hi[group], end), end), row + 1)
    count = end - frm
    done = np.concatenate(([0], np.cumsum(count)))
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(done, done[at] + at_once, "right")) - 1)
        a = np.repeat(row[at:to], count[at:to])
        if len(a):
            yield a, np.arange(len(a)) - np.repeat(done[at:to] - done[at], count[at:to]) + np.repeat(frm[at:to], count[at:to])
        at = to


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (the least row of each set) after uniting a[i] with b[i]."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return label
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def components(spark: SparkSession, edges: DataFrame, name: str) -> DataFrame:
    """(u, root): the least id in the component of each u of ``edges`` (a, b); alternating stars until they hold."""
    now = stored(spark, edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    before = None
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # stored, so that a hub's neighbours reach the join by a shuffle of their own, which Spark may split
        least = stored(spark, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name)
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select("u", F.col("m").alias("v")).unionByName(
            small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        now = stored(spark, small, name)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select("u", F.col("v").alias("root"))
        before = state
