"""File sources: raw trip CSV, batch CSV files and their listing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..operators.batching import batch_file_name
from ..schemas import RAW_SCHEMA, TRIP_COLUMNS, TRIP_SCHEMA
from ..session import scratch_path

# Raw source files carry the arrival position as a leading column.
RAW_FILE_SCHEMA = StructType([StructField("row_no", LongType(), True), *RAW_SCHEMA.fields])

# Batch files: the trip columns in message order, then the arrival position.
BATCH_FILE_SCHEMA = StructType([*TRIP_SCHEMA.fields, StructField("row_no", LongType(), True)])
BATCH_COLUMNS = [*TRIP_COLUMNS, "row_no"]

# Splits of a plain CSV source whose starts are broadcast (two numbers each); beyond, they are joined by shuffle.
MAX_BROADCAST_SPLITS = 4_000_000

# Fixed value: text that stands for NULL when reading raw CSV (unquoted empty cells map to it).
NULL_MARKER = "\\N"


def read_raw_csv(spark: SparkSession, path: str, schema: StructType = RAW_FILE_SCHEMA) -> DataFrame:
    """Header CSV, every trip cell kept as text.

    A blank unquoted cell reads as NULL and a quoted empty one (``""``) as
    ``''`` (the NULL marker is moved off the empty string for that); the typing
    step treats both as missing. A missing path raises Spark's
    ``PATH_NOT_FOUND`` analysis error unchanged (S3).
    """
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("nullValue", NULL_MARKER).csv(path))


def read_plain_csv(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA) -> DataFrame:
    """Header CSV as the original's source has it: the trip columns, no position column.

    The files' header must name the schema's columns in order, else the read fails. Adds ``row_no``, the
    0-based position in file order (path, then place in the file) over all files: Spark reads each
    split in order, so a row's place is the rows of all splits before its own plus its rank there. A first pass, without the columns, counts
    the splits' rows into a stored table of one row a split. A split is looked up by a hash of file and place, checked to be
    unique among the splits: two numbers for each, so the table is broadcast up to ``MAX_BROADCAST_SPLITS``. Nothing is sorted.
    """
    df = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
          .option("nullValue", NULL_MARKER).csv(path))
    # ids grow in reading order inside a task; a split's ids are consecutive
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_id"))
    counted = scratch_path(spark, "splits")
    placed.groupBy("_file", "_at").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).write.mode("overwrite").parquet(counted)
    counts = spark.read.parquet(counted)
    before = F.sum("_n").over(Window.orderBy("_file", "_at")) - F.col("_n")  # a row a split
    for seed in range(8):
        key = F.xxhash64(F.lit(seed), "_file", "_at")
        n = counts.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("keys")).first()
        if n["n"] == n["keys"]:
            break
    else:
        raise RuntimeError("the splits' hashes are not unique")
    starts = counts.select(key.alias("_split"), (before - F.col("_first")).alias("_shift"))
    if n["n"] <= MAX_BROADCAST_SPLITS:
        starts = F.broadcast(starts)
    return placed.withColumn("_split", key).join(starts, "_split").select((F.col("_id") + F.col("_shift")).alias("row_no"), *schema.names)


def first_rows(raw: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records of a source (S2, ``nrows=n``).

    ``row_no`` is the 0-based arrival position the source carries, so this is a
    filter that reaches the scan; a sort + limit would funnel up to ``n`` rows
    per partition through a single task.
    """
    return raw.filter(F.col("row_no") < F.lit(n))


def write_raw_csv(raw: DataFrame, path: str) -> None:
    raw.write.mode("overwrite").option("header", True).csv(path)


def write_batches_csv(batched: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per batch, ``batch_no=<n>/`` (K3).

    No extra shuffle: tasks hold scattered key buckets, so each writes, sorted, its rows of
    every batch it meets, and a batch has several part files.
    """
    (batched.sortWithinPartitions("batch_no", "row_no")
            .select(*BATCH_COLUMNS, "batch_no")
            .write.mode(mode).partitionBy("batch_no").option("header", True).csv(path))


def write_batches_flat(batched: DataFrame, path: str, batch_size: int, files: int | None = None, compression: str = "none") -> None:
    """Batches as the original's files hold them: one CSV per batch, ``batch_<n>.csv``, the short last one
    ``batch_<n>_final.csv`` (K3-K5).

    Each batch is one file, written whole by one task: at most ``batch_size`` rows. The name goes through a
    partition folder (``file=batch_<n>.csv/``), since Spark names part files itself.
    """
    last = F.max("batch_no").alias("last")
    top = batched.agg(last, F.count(F.lit(1)).alias("n")).first()
    short = top["last"] is not None and top["n"] % batch_size != 0
    name = batch_file_name("batch_no", (F.col("batch_no") == F.lit(top["last"])) & F.lit(short))
    (batched.repartition(*([files] if files else []), "batch_no").sortWithinPartitions("batch_no", "row_no")
            .select(*BATCH_COLUMNS, name.alias("file"))
            .write.mode("overwrite").partitionBy("file").option("header", True).option("compression", compression).csv(path))


def write_batches_table(batched: DataFrame, path: str) -> None:
    """Batches as a column of large Parquet files, for small N: no folder per batch (K5)."""
    (batched.sortWithinPartitions("batch_no", "row_no").select(*BATCH_COLUMNS, "batch_no").write.mode("overwrite").parquet(path))


# Number of a batch file: ``batch_<n>.csv``, ``batch_<n>_final.csv`` (as a file or a folder) or ``batch_no=<n>``.
BATCH_PATH = r"batch_(?:no=)?([0-9]+)(?:_final\.csv|\.csv|/|$)"


def _batch_of(path) -> Column:
    return F.regexp_extract(path, BATCH_PATH, 1).try_cast("int")


def read_batch_files(spark: SparkSession, path: str) -> DataFrame:
    """Flat batch files with the original's eight columns (S6, S7): trips, ``batch_no`` from the name.

    Files named otherwise are left alone, as the original's listing does.
    """
    df = spark.read.schema(TRIP_SCHEMA).option("header", True).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").csv(path)
    return df.withColumn("batch_no", _batch_of(F.col("_metadata.file_path"))).filter(F.col("batch_no").isNotNull())


def read_batches_csv(spark: SparkSession, path: str, batches: list[int] | None = None) -> DataFrame:
    """Batch files with the fixed trip schema (S7); ``batch_no`` from the folder.

    A filter on ``batch_no`` prunes folders before any file is opened.
    """
    schema = StructType([*BATCH_FILE_SCHEMA.fields, StructField("batch_no", IntegerType(), True)])
    df = spark.read.schema(schema).option("header", True).csv(path)
    if batches is not None:
        df = df.filter(F.col("batch_no").isin(list(batches)))
    return df


def read_batches_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Docs variant: glob over every batch file with schema inference."""
    return spark.read.option("header", True).option("inferSchema", True).csv(f"{path}/batch_no=*/*.csv")


def list_batch_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch: ``batch_no``, ``file_name``, ``n_files``.

    Lists files only (binary-file source with the content column pruned), so no data is read. Takes
    both layouts, ``batch_no=<n>/*.csv`` and ``batch_<n>[_final].csv``; other CSV files are left alone.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
             .option("recursiveFileLookup", "true").load(path).select("path", "length"))
    final = F.col("path").rlike(r"batch_[0-9]+_final\.csv")
    listed = (files.select(_batch_of(F.col("path")).alias("batch_no"), final.alias("final"), "length").filter("batch_no is not null")
                   .groupBy("batch_no").agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"), F.max("final").alias("final")))
    return listed.withColumn("file_name", batch_file_name("batch_no", "final")).drop("final")


def unreadable_batches(spark: SparkSession, path: str, batches: list[int]) -> set[int]:
    """Those of ``batches`` whose folder cannot be read (S9): the folder is missing. For files that fail while they are read see ``quarantine``."""
    return {b for b in batches if read_csv_skipping_unreadable(spark, [f"{path}/batch_no={b}"])[1]}


def read_csv_skipping_unreadable(spark: SparkSession, paths: list[str], schema: StructType = BATCH_FILE_SCHEMA):
    """Read several CSV paths, skipping any that cannot be planned.

    Returns ``(frame_or_None, skipped_paths)``. Only plan-time failures (a
    missing path) are caught here; corrupt content is Spark's
    ``spark.sql.files.ignoreCorruptFiles`` business.
    """
    frames, skipped = [], []
    for p in paths:
        try:
            frames.append(spark.read.schema(schema).option("header", True).csv(p))
        except AnalysisException:  # a path that is missing or cannot be planned
            skipped.append(p)
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out, skipped
