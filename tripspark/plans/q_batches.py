"""Registered queries: batching, batch files, cumulative training sets (§2.1 S1/S6-S8, §2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timefeat import parse_pickup, utc_text
from ..operators import batching, ingest, versions
from ..schemas import TRIP_COLUMNS
from ..session import scratch_path
from ..sources import files
from . import frames
from .oracle_base import BATCH_SIZE_SQL, with_pipeline
from .registry import query

TRIP_SQL = ", ".join(TRIP_COLUMNS)
RAW_SQL = "row_no, key, fare_amount, pickup_datetime, pickup_longitude, pickup_latitude, " \
          "dropoff_longitude, dropoff_latitude, passenger_count"

# Batch catalog in SQL: one row per batch with its file name and both orders.
CATALOG_CTES = f"""
bc AS (SELECT batch_no, count(*) AS n_rows FROM b GROUP BY batch_no),
cat AS (SELECT batch_no, 'batch_' || CAST(batch_no AS VARCHAR)
          || CASE WHEN n_rows < {BATCH_SIZE_SQL} THEN '_final' ELSE '' END || '.csv' AS file_name FROM bc),
pos AS (SELECT batch_no, file_name,
          CAST(row_number() OVER (ORDER BY batch_no) AS INTEGER) AS pos_numeric,
          CAST(row_number() OVER (ORDER BY file_name) AS INTEGER) AS pos_lexical FROM cat),
vb AS (SELECT CAST(v AS INTEGER) AS version, p.batch_no, p.pos_numeric, p.pos_lexical
       FROM pos p JOIN range(1, 4) t(v) ON true)
"""


@query("scan_csv_strings", with_pipeline(f"SELECT {RAW_SQL} FROM raw"))
def scan_csv_strings(spark, sf_dir):
    """Header CSV scan with every trip cell as text."""
    return frames.raw(spark, sf_dir)


@query("batch_assign", with_pipeline("SELECT row_no, batch_no FROM b"))
def batch_assign(spark, sf_dir):
    """Record i of the arrival order → batch i div N + 1, without a global window."""
    return frames.batched(spark, sf_dir).select("row_no", "batch_no")


@query("batch_assign_1000", with_pipeline(
    "SELECT row_no, CAST((row_number() OVER (ORDER BY row_no) - 1) // 1000 + 1 AS INTEGER) AS batch_no FROM sent"))
def batch_assign_1000(spark, sf_dir):
    """Docs variant: 1,000-record batches (K5)."""
    return frames.batched(spark, sf_dir, batch_size=1000).select("row_no", "batch_no")


@query("batch_files_flat", with_pipeline(
    "SELECT batch_no, file_name, count(*) AS n_rows, min(row_no) AS first_row FROM (SELECT row_no, n, "
    "CAST((p // 1000) + 1 AS INTEGER) AS batch_no, 'batch_' || CAST(p // 1000 + 1 AS VARCHAR) "
    "|| CASE WHEN p // 1000 = n // 1000 THEN '_final' ELSE '' END || '.csv' AS file_name "
    "FROM (SELECT row_no, row_number() OVER (ORDER BY row_no) - 1 AS p, count(*) OVER () AS n FROM sent)) GROUP BY ALL"))
def batch_files_flat(spark, sf_dir):
    """Batches of 1,000 written as ``batch_<n>[_final].csv``, listed and read back."""
    path = scratch_path(spark, "batches_flat")
    files.write_batches_flat(frames.batched(spark, sf_dir, batch_size=1000), path, 1000)
    names = files.list_batch_files(spark, path).select("batch_no", "file_name")
    rows = spark.read.schema(files.BATCH_FILE_SCHEMA).option("header", True).option("recursiveFileLookup", "true").csv(path)
    rows = rows.select("row_no", files._batch_of(F.col("_metadata.file_path")).alias("batch_no"))
    return rows.groupBy("batch_no").agg(F.count(F.lit(1)).alias("n_rows"), F.min("row_no").alias("first_row")).join(names, "batch_no")


@query("batch_table_1000", with_pipeline(
    "SELECT row_no, CAST((row_number() OVER (ORDER BY row_no) - 1) // 1000 + 1 AS INTEGER) AS batch_no FROM sent"))
def batch_table_1000(spark, sf_dir):
    """Batches of 1,000 stored as a column of large files, read back (K5)."""
    path = scratch_path(spark, "batches_table")
    files.write_batches_table(frames.batched(spark, sf_dir, batch_size=1000), path)
    return spark.read.parquet(path).select("row_no", "batch_no")


@query("scan_plain_csv", with_pipeline(
    f"SELECT row_number() OVER (ORDER BY row_no) - 1 AS row_no, {RAW_SQL.split(', ', 1)[1]} FROM raw"))
def scan_plain_csv(spark, sf_dir):
    """The source as the original has it, eight columns and no position: positions from the files."""
    return files.read_plain_csv(spark, frames.plain_csv(spark, sf_dir))


@query("batch_from_plain_csv", with_pipeline(
    "SELECT p.pos AS row_no, b.batch_no, b.fare_amount FROM b JOIN "
    "(SELECT row_no, row_number() OVER (ORDER BY row_no) - 1 AS pos FROM raw) p ON p.row_no = b.row_no"))
def batch_from_plain_csv(spark, sf_dir):
    """Plain header CSV → validated trips → numbered batches."""
    raw = files.read_plain_csv(spark, frames.plain_csv(spark, sf_dir))
    n = batching.fixture_batch_size(spark, sf_dir)
    return batching.assign_batches(ingest.accepted(ingest.type_trips(raw)), n).select("row_no", "batch_no", "fare_amount")


@query("batch_sizes", with_pipeline(
    f"SELECT batch_no, count(*) AS n_rows, count(*) < {BATCH_SIZE_SQL} AS is_final FROM b GROUP BY batch_no"))
def batch_sizes(spark, sf_dir):
    """Records per batch and the short final batch (A3, K4)."""
    n = batching.fixture_batch_size(spark, sf_dir)
    return batching.batch_sizes(frames.trips(spark, sf_dir), batch_size=n)


@query("scan_batch_csv", with_pipeline(f"SELECT row_no, batch_no, {TRIP_SQL} FROM b"))
def scan_batch_csv(spark, sf_dir):
    """Batch files read back with the fixed trip schema (K3 → S7)."""
    return frames.trips(spark, sf_dir)


@query("scan_glob_infer", with_pipeline(
    "SELECT row_no, batch_no, fare_amount, strftime(pts, '%Y-%m-%d %H:%M:%S') AS pickup_ts, passenger_count FROM b"))
def scan_glob_infer(spark, sf_dir):
    """Docs variant: glob over all batch files with an inferred schema.

    Inference makes ``pickup_datetime`` a TIMESTAMP, ``passenger_count`` INT and
    ``row_no`` INT or BIGINT; the query casts to fixed output types.
    """
    df = files.read_batches_inferred(spark, frames.ingest_batches(spark, sf_dir))
    # A text column only when some value is not a time (e.g. 'garbage').
    ts = F.col("pickup_datetime")
    if dict(df.dtypes)["pickup_datetime"] == "string":
        ts = parse_pickup(ts)
    return df.select(F.col("row_no").try_cast("bigint").alias("row_no"),
                     F.regexp_extract(F.input_file_name(), r"batch_no=(\d+)", 1).try_cast("int").alias("batch_no"),
                     F.col("fare_amount").try_cast("double").alias("fare_amount"),
                     utc_text(ts).alias("pickup_ts"),
                     F.col("passenger_count").try_cast("int").alias("passenger_count"))


def _listing(spark, sf_dir):
    n = batching.fixture_batch_size(spark, sf_dir)
    return versions.batch_catalog(spark, frames.ingest_batches(spark, sf_dir), n)


@query("batch_files_numeric", with_pipeline(
    "SELECT file_name, batch_no, pos_numeric AS position FROM pos", CATALOG_CTES))
def batch_files_numeric(spark, sf_dir):
    """Batch file names in numeric order."""
    return _listing(spark, sf_dir).select("file_name", "batch_no", F.col("pos_numeric").alias("position"))


@query("batch_files_lexical", with_pipeline(
    "SELECT file_name, batch_no, pos_lexical AS position FROM pos", CATALOG_CTES))
def batch_files_lexical(spark, sf_dir):
    """Batch file names sorted as text, as the original trainer listed them."""
    return _listing(spark, sf_dir).select("file_name", "batch_no", F.col("pos_lexical").alias("position"))


@query("union_by_name", with_pipeline(
    "SELECT row_no, batch_no, CASE WHEN batch_no <= 3 THEN key END AS key FROM b"))
def union_by_name(spark, sf_dir):
    """Union by column name; a column missing on one side becomes NULL.

    The first three batches keep ``key``, later ones arrive without it, in
    another column order; all rows come out.
    """
    t = frames.trips(spark, sf_dir)
    first = t.filter(F.col("batch_no") <= 3).select("row_no", "batch_no", "key")
    later = t.filter(F.col("batch_no") > 3).select("batch_no", "row_no")
    return first.unionByName(later, allowMissingColumns=True)


@query("cumulative_training_sets", with_pipeline(
    "SELECT CAST(v AS INTEGER) AS version, g.row_no FROM g JOIN range(1, 4) t(v) ON g.batch_no <= t.v"))
def cumulative_training_sets(spark, sf_dir):
    """Version k trains on batches 1..k: one scan + a bounded fan-out, no growing union."""
    cleaned = frames.cleaned(spark, sf_dir, batch=True)
    vb = versions.version_batches(_listing(spark, sf_dir), k=3, order="numeric")
    return versions.versioned_rows(cleaned, vb).select("version", "row_no")


_COUNTS_SQL = """SELECT vb.version, CAST(count(DISTINCT vb.batch_no) AS BIGINT) AS n_batches,
  CAST(sum(bc.n_rows) AS BIGINT) AS n_trips, CAST(sum(coalesce(gc.n_clean, 0)) AS BIGINT) AS n_cleaned
FROM vb JOIN bc ON vb.batch_no = bc.batch_no
LEFT JOIN (SELECT batch_no, count(*) AS n_clean FROM g GROUP BY batch_no) gc ON vb.batch_no = gc.batch_no
WHERE vb.{pos} <= vb.version GROUP BY vb.version"""


@query("cumulative_counts", with_pipeline(_COUNTS_SQL.format(pos="pos_numeric"), CATALOG_CTES))
def cumulative_counts(spark, sf_dir):
    """Per version: batches used, trips, cleaned training rows (A1, T3), numeric order."""
    return versions.cumulative_counts(frames.featured(spark, sf_dir),
                                      versions.version_batches(_listing(spark, sf_dir), k=3, order="numeric"))


@query("cumulative_counts_lexical", with_pipeline(_COUNTS_SQL.format(pos="pos_lexical"), CATALOG_CTES))
def cumulative_counts_lexical(spark, sf_dir):
    """Same with the original's text order of file names (batches 1, 10, 11)."""
    return versions.cumulative_counts(frames.featured(spark, sf_dir),
                                      versions.version_batches(_listing(spark, sf_dir), k=3, order="lexical"))
