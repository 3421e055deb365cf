"""Distributed dense index and batch assignment (T1, A3) against row_number."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripspark.operators import batching


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_dense_index_equals_row_number(spark, buckets):
    rnd = random.Random(buckets)
    keys = rnd.sample(range(10_000_000), 2500)
    df = spark.createDataFrame([(k,) for k in keys], "k BIGINT").repartition(7)
    got = batching.dense_index(df, "k", num_buckets=buckets)
    want = df.withColumn("want", F.row_number().over(Window.orderBy("k")) - 1)
    bad = got.join(want, "k").filter(F.col("row_idx") != F.col("want")).count()
    assert bad == 0 and got.count() == len(keys)


def test_skewed_keys_still_exact(spark):
    # a third of all rows packed into a tiny key range, the rest spread wide
    keys = list(range(1000)) + [10_000_000 + 7919 * i for i in range(2000)]
    df = spark.createDataFrame([(k,) for k in keys], "k BIGINT")
    idx = sorted((r.k, r.row_idx) for r in batching.dense_index(df, "k", num_buckets=8).collect())
    assert [i for _, i in idx] == list(range(len(keys)))


def test_batches_exact_sizes(spark):
    df = spark.createDataFrame([(k * 3,) for k in range(1003)], "row_no BIGINT")
    b = batching.assign_batches(df, 100)
    sizes = {r.batch_no: r.n_rows for r in batching.batch_sizes(b, 100).collect()}
    assert sizes == {**{i: 100 for i in range(1, 11)}, 11: 3}
    fin = {r.batch_no: r.is_final for r in batching.batch_sizes(b, 100).collect()}
    assert fin[11] and not fin[10]


def test_multiple_of_n_has_no_short_batch(spark):
    df = spark.createDataFrame([(k,) for k in range(300)], "row_no BIGINT")
    sizes = batching.batch_sizes(batching.assign_batches(df, 100), 100).collect()
    assert sorted((r.batch_no, r.n_rows, r.is_final) for r in sizes) == [(1, 100, False), (2, 100, False),
                                                                          (3, 100, False)]


def test_batch_size_validated(spark):
    df = spark.createDataFrame([(1,)], "row_no BIGINT")
    with pytest.raises(ValueError):
        batching.assign_batches(df, 0)


def _positions(df, **kw):
    """Positions must be 0..n-1 in key order (NULL last), ties in any order."""
    rows = sorted((r.row_idx, r.k) for r in batching.dense_index(df, "k", **kw).collect())
    assert [i for i, _ in rows] == list(range(len(rows)))
    keys = [k for _, k in rows]
    assert keys == sorted(keys, key=lambda k: (k is None, k or 0))
    return rows


@pytest.mark.parametrize("buckets", [1, 8, 64])
def test_repeated_and_null_keys_are_split_and_exact(spark, buckets):
    keys = [7] * 1000 + [None] * 700 + list(range(10_000, 12_000)) + [3]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k BIGINT, v INT").repartition(5)
    assert len(_positions(df, num_buckets=buckets)) == len(keys)


def test_hot_key_is_dealt_to_several_tasks(spark):
    df = spark.createDataFrame([(7, i) for i in range(5000)] + [(k, k) for k in range(100, 200)], "k BIGINT, v INT")
    got = batching.dense_index(df, "k", num_buckets=32)
    sizes = got.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 2 and max(r["count"] for r in sizes) < 4000


def test_clustered_survivors_of_a_filter(spark):
    df = spark.range(100_000).select(F.col("id").alias("k")).filter("k >= 50000 and k < 55000")
    assert len(_positions(df, num_buckets=200)) == 5000


def test_equal_rows_and_keys_beyond_doubles(spark):
    big = 2 ** 60
    df = spark.createDataFrame([(big + i % 5, 1) for i in range(400)], "k BIGINT, v INT")
    assert len(_positions(df, num_buckets=16)) == 400


@pytest.mark.parametrize("buckets", [600, 2000, 5000])
def test_more_buckets_than_splits(spark, buckets):
    """The driver finds at most MAX_SPLITS quantiles; the rest of the buckets are even cuts between them."""
    keys = [k * k for k in range(3000)] + [-5] * 900 + [None] * 40
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k BIGINT, v INT").repartition(5)
    assert len(_positions(df, num_buckets=buckets)) == len(keys)
    used = batching.key_buckets(df, "k", buckets).groupBy("_bucket").count().collect()
    assert len(used) > 400 and max(r["count"] for r in used if r["count"] != 900) < 200


def test_not_a_number_keys_and_no_rows(spark):
    nan = float("nan")
    df = spark.createDataFrame([(x,) for x in [nan, 2.0, None, float("inf"), 1.0, float("-inf"), nan]], "k DOUBLE")
    got = [r.k for r in sorted(batching.dense_index(df, "k", num_buckets=4).collect(), key=lambda r: r.row_idx)]
    assert got[:4] == [float("-inf"), 1.0, 2.0, float("inf")] and got[4] != got[4] and got[5] != got[5] and got[6] is None
    assert batching.dense_index(df.filter("false"), "k").count() == 0
