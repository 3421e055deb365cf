"""Arrival-order batching.

Record ``i`` (0-based, in arrival order) belongs to batch ``i div N + 1``. A
global ``row_number()`` would pull every row into one task, so the position is
computed as a distributed dense index whose every step is a pure function of
the data (no dependence on how the input happens to be partitioned):

1. one aggregate gives up to ``MAX_SPLITS`` quantiles of the order key from a summary of fixed size, however many buckets are asked
   for; a value that fills several quantiles gets a bucket of its own;
2. the range between two splits is cut evenly into the buckets that are still missing;
3. rows per bucket (partial aggregation, one small distributed table); a bucket above its fair share that holds a single key value (or NULL) is cut
   further by a hash of the tie-breaking columns;
4. exclusive prefix sums over the buckets' counts;
5. ``row_number()`` inside each bucket, one shuffle;
6. position = bucket offset + local rank.

The driver sees the splits and two numbers, never the table of buckets. Rows with equal keys are ordered by 128 bits of hashes of the tie-breaking
columns. A recomputed task after an executor loss produces the same numbers. Rows equal in all columns are
interchangeable; only those cannot be cut apart.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Key buckets per shuffle partition: bucket ids are hashed to partitions, so a few
# buckets per partition even out the per-task load of the in-bucket ranking.
BUCKETS_PER_PARTITION = 4
# Quantiles that one aggregate finds, and the accuracy (size) of its summary.
MAX_SPLITS = 512
ACCURACY = 10_000
# The table of bucket offsets is broadcast up to this many rows, and shuffled beyond.
MAX_BROADCAST_BUCKETS = 100_000


def index_buckets(df: DataFrame, num_buckets: int | None = None) -> int:
    n = int(num_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")) * BUCKETS_PER_PARTITION)
    if n < 1:
        raise ValueError(f"index buckets must be positive, got {n}")
    return n


def key_buckets(df: DataFrame, key: str, num_buckets: int, out: str = "_bucket") -> DataFrame:
    """Add ``out`` (BIGINT) = bucket of the numeric ``key``, growing with it; NaN after all numbers, NULL last."""
    number = F.col(key).cast("double")
    number = F.when(~F.isnan(number), number)
    k = min(num_buckets, MAX_SPLITS)
    probs = [i / k for i in range(1, k)] or [0.5]
    found = df.agg(F.percentile_approx(number, probs, ACCURACY).alias("q"), F.min(number).alias("lo"), F.max(number).alias("hi")).first()
    bounds = sorted(found["q"] or []) if k > 1 else []
    # a value that is several quantiles at once holds many rows: [b, next float) is its own bucket
    alone = [math.nextafter(a, math.inf) for a, b in zip(bounds, bounds[1:]) if a == b]
    inner = sorted(b for b in {*bounds, *alone} if math.isfinite(b))
    per = -(-num_buckets // (len(inner) + 1))  # even cuts between two splits
    keyed = df.withColumn("_key_d", number)
    if inner:
        b = Bucketizer(splits=[float("-inf"), *inner, float("inf")], inputCol="_key_d", outputCol="_part", handleInvalid="keep")
        keyed = b.transform(keyed).withColumn("_part", F.col("_part").cast("int"))
    else:
        keyed = keyed.withColumn("_part", F.lit(0))
    sub = F.lit(0)
    if per > 1 and found["lo"] is not None:
        edges = [min(found["lo"], inner[0]) if inner else found["lo"], *inner, found["hi"]]
        low = F.get(F.array(*map(F.lit, edges[:-1])), F.col("_part"))
        wide = F.get(F.array(*[F.lit(max(y - x, 0.0) if math.isfinite(y - x) else 0.0) for x, y in zip(edges, edges[1:])]), F.col("_part"))
        share = F.when(wide > 0, (F.col("_key_d") - low) / wide).otherwise(0.0)
        sub = F.least(F.greatest(F.floor(share * per), F.lit(0)), F.lit(per - 1))
    last = (len(inner) + 1) * per
    place = F.when(F.col("_key_d").isNotNull(), F.col("_part").cast("long") * per + F.coalesce(sub, F.lit(0))).when(F.col(key).isNotNull(), F.lit(last)).otherwise(F.lit(last + 1))
    return keyed.withColumn(out, place.cast("long")).drop("_key_d", "_part")


def dense_index(df: DataFrame, order_by: str, out: str = "row_idx",
                num_buckets: int | None = None, ties: list[str] | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of each row in ``order_by`` order (NULL keys last).

    ``order_by`` is one numeric column; values may repeat. ``ties`` (all other columns by
    default) order rows of equal keys. Triggers two small jobs when called: the splits, and whether a bucket must be cut.
    """
    n = index_buckets(df, num_buckets)
    ties = [c for c in df.columns if c != order_by] if ties is None else list(ties)
    tied = [F.col(f"`{c}`") for c in ties]
    bucketed = key_buckets(df, order_by, n).withColumns({"_tie": F.xxhash64(F.lit(0), *tied), "_tie2": F.xxhash64(F.lit(1), *tied)})
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"), F.min(order_by).alias("_lo"), F.max(order_by).alias("_hi"))
    fair = F.ceil(F.sum("_n").over(Window.partitionBy()) / n) + 64  # the table has a row a bucket
    single = F.col("_lo").eqNullSafe(F.col("_hi"))
    cuts = counts.withColumn("_cuts", F.when(single & (F.col("_n") > fair), F.ceil(F.col("_n") / fair)).otherwise(1).cast("int")).select("_bucket", "_n", "_cuts")
    size = cuts.agg(F.sum("_cuts").alias("rows"), F.max("_cuts").alias("most")).first()
    if (size["most"] or 1) > 1:
        # the tie hash, spread evenly over the bucket's cuts in hash order
        share = (F.col("_tie").cast("double") + 2.0 ** 63) / 2.0 ** 64
        few = cuts.filter("_cuts > 1").select("_bucket", "_cuts")  # at most a bucket for each fair share of rows
        bucketed = bucketed.join(F.broadcast(few) if n <= MAX_BROADCAST_BUCKETS else few, "_bucket", "left")
        pieces = F.coalesce("_cuts", F.lit(1))
        bucketed = bucketed.withColumn("_sub", F.least(F.floor(share * pieces).cast("int"), pieces - 1)).drop("_cuts")
        parts = bucketed.groupBy("_bucket", "_sub").agg(F.count(F.lit(1)).alias("_n"))
    else:
        bucketed = bucketed.withColumn("_sub", F.lit(0))
        parts = cuts.select("_bucket", F.lit(0).alias("_sub"), "_n")
    # bounded by the number of buckets and cuts (at most twice the buckets)
    before = F.sum("_n").over(Window.orderBy("_bucket", "_sub")) - F.col("_n")
    offsets = parts.select("_bucket", "_sub", before.cast("long").alias("_offset"))
    if (size["rows"] or 0) <= MAX_BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    local = F.row_number().over(Window.partitionBy("_bucket", "_sub").orderBy(F.col(order_by).asc_nulls_last(), "_tie", "_tie2")) - 1
    return (bucketed.withColumn("_local", local)
                    .join(offsets, ["_bucket", "_sub"])
                    .withColumn(out, F.col("_offset") + F.col("_local"))
                    .drop("_bucket", "_sub", "_tie", "_tie2", "_local", "_offset"))


def assign_batches(df: DataFrame, batch_size: int, order_by: str = "row_no",
                   out: str = "batch_no", num_buckets: int | None = None,
                   keep_index: bool = False) -> DataFrame:
    """Add ``batch_no`` (1-based, INT): rows ``[k*N, (k+1)*N)`` of the order form batch k+1."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    idx = dense_index(df, order_by, out="_row_idx", num_buckets=num_buckets)
    idx = idx.withColumn(out, (F.expr(f"_row_idx div {int(batch_size)}") + 1).cast("int"))
    return idx.withColumnRenamed("_row_idx", "row_idx") if keep_index else idx.drop("_row_idx")


def fixture_batch_size(spark, sf_dir: str) -> int:
    """Batch size used by the registered queries: 8 % of the raw rows (≥ 1).

    The original batches 10,000 messages; scaling the size with the table keeps
    the same shape (12 batches, the last one short) at every scale factor.
    The count is answered from parquet footers.
    """
    n = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").count()
    return max(n * 8 // 100, 1)


def batch_sizes(batched: DataFrame, batch_size: int | None = None) -> DataFrame:
    """Records per batch (A3); with ``batch_size``, flag the short final batch."""
    out = batched.groupBy("batch_no").agg(F.count(F.lit(1)).alias("n_rows"))
    if batch_size is not None:
        out = out.withColumn("is_final", F.col("n_rows") < F.lit(batch_size))
    return out


def batch_file_name(batch_no, is_final=None):
    """``batch_<n>.csv``, or ``batch_<n>_final.csv`` for the short last batch."""
    base = F.concat(F.lit("batch_"), F.col(batch_no).cast("string") if isinstance(batch_no, str) else batch_no)
    if is_final is None:
        return F.concat(base, F.lit(".csv"))
    fin = F.col(is_final) if isinstance(is_final, str) else is_final
    return F.concat(base, F.when(fin, F.lit("_final")).otherwise(F.lit("")), F.lit(".csv"))


def first_batches(batched: DataFrame, k: int) -> DataFrame:
    """Rows of batches 1..k (T3/U2): one filter instead of a growing union."""
    return batched.filter(F.col("batch_no") <= k)
