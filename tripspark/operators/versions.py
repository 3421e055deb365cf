"""Batch catalog and cumulative model versions.

Version k of the model trains on the first k batch files. The catalog has one
row per batch folder; it comes from the file listing, which Spark's file index
already holds on the driver, so its windows are bounded by the number of files.
The version → batch table has at most k(k+1)/2 rows and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import files
from . import quality
from .batching import batch_file_name

ORDERS = ("numeric", "lexical")


def batch_catalog(spark: SparkSession, path: str, batch_size: int) -> DataFrame:
    """``batch_no, file_name, n_files, pos_numeric, pos_lexical`` for every batch folder.

    The last batch is ``batch_<n>_final.csv`` when it is short; finding that out
    reads only the last folder (partition pruning).
    """
    listing = files.list_batch_files(spark, path)
    last = listing.agg(F.max("batch_no")).first()[0]
    if last is None:
        raise ValueError(f"no batch files under {path}")
    n_last = files.read_batches_csv(spark, path, batches=[last]).count()
    is_final = (F.col("batch_no") == F.lit(last)) & F.lit(n_last < batch_size)
    cat = listing.select("batch_no", "n_files", batch_file_name("batch_no", is_final).alias("file_name"))
    return (cat.withColumn("pos_numeric", F.row_number().over(Window.orderBy("batch_no")))
               .withColumn("pos_lexical", F.row_number().over(Window.orderBy("file_name"))))


def version_batches(catalog: DataFrame, k: int = 3, order: str = "numeric") -> DataFrame:
    """``version, batch_no``: version v uses the first v batches in ``order``.

    Only min(k, number of batches) versions exist, as in the original.
    """
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}")
    pos = F.col(f"pos_{order}")
    n_versions = F.least(F.lit(k), F.max(pos).over(Window.partitionBy(F.lit(1))))
    first = catalog.withColumn("_kk", n_versions).filter(pos <= k)
    vb = (first.select("batch_no", F.explode(F.sequence(pos, F.col("_kk"))).alias("version"))
               .select(F.col("version").cast("int").alias("version"), "batch_no"))
    # At most k(k+1)/2 rows: kept as a local table so plans that join it do not
    # list the batch files again.
    rows = vb.collect()
    if len(rows) > k * (k + 1) // 2:
        raise ValueError("version table larger than its bound")
    return catalog.sparkSession.createDataFrame(rows, "version INT, batch_no INT")


def versioned_rows(df: DataFrame, vb: DataFrame) -> DataFrame:
    """Each row once per version whose training set contains its batch (fan-out ≤ k).

    The few batch numbers involved become a literal filter first, so a scan of
    batch folders is pruned to them before any file is opened.
    """
    batches = sorted({r["batch_no"] for r in vb.select("batch_no").collect()})
    return df.filter(F.col("batch_no").isin(batches)).join(F.broadcast(vb), "batch_no")


def cumulative_counts(featured: DataFrame, vb: DataFrame) -> DataFrame:
    """Per version: batches, trips and cleaned training rows (A1).

    One scan, one aggregate: ``featured`` are all trips with their features;
    the cleaning rules count as a flag instead of a second filtered scan.
    """
    keep = F.coalesce(quality.all_rules(), F.lit(False))
    return (versioned_rows(featured, vb).groupBy("version")
            .agg(F.count_distinct("batch_no").alias("n_batches"), F.count(F.lit(1)).alias("n_trips"),
                 F.count_if(keep).alias("n_cleaned")))
