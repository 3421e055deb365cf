"""Batch files that cannot be read are set aside with a reason; the rest of a job goes on.

One listing (no content) and one read under ``ignoreCorruptFiles``, which skips what fails in the middle of a file, tell every file's state:

* ``unreadable``: it has bytes but not one row could be read (no such codec, a broken footer, a file cut in its first block);
* ``truncated``: fewer rows than a batch holds, in a file that is not the final one, so reading broke off or the writer did;
* ``bad_record``: a row does not fit the schema's number of columns;
* ``empty``: nothing but a header.

A final file that lost rows cannot be told from a short one unless ``rows_of`` gives the rows it should have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import TRIP_SCHEMA
from .files import _batch_of

CORRUPT = "_corrupt"
_LENIENT = {"ignoreCorruptFiles": "true", "ignoreMissingFiles": "true", "recursiveFileLookup": "true"}


def read_leniently(spark: SparkSession, path: str, schema: StructType = TRIP_SCHEMA, glob: str = "*.csv*") -> DataFrame:
    """Rows of all CSV batch files that can be read, with ``batch_no``, ``file`` and the text of a row that doesn't fit (else NULL)."""
    fields = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    df = (spark.read.schema(fields).option("header", True).option("columnNameOfCorruptRecord", CORRUPT).option("pathGlobFilter", glob)
          .option("columnPruning", False).options(**_LENIENT).csv(path))  # only whole rows show whether they fit
    return df.withColumn("file", F.col("_metadata.file_path")).withColumn("batch_no", _batch_of(F.col("file"))).filter("batch_no is not null")


def file_states(spark: SparkSession, path: str, batch_size: int, schema: StructType = TRIP_SCHEMA, glob: str = "*.csv*", rows_of: DataFrame | None = None) -> DataFrame:
    """One row a batch file: ``file``, ``batch_no``, ``n_bytes``, ``n_rows`` read, ``reason`` (NULL: sound). ``rows_of``: (batch_no, n_expected)."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
              .select(F.col("path").alias("file"), F.col("length").alias("n_bytes"), _batch_of(F.col("path")).alias("batch_no")).filter("batch_no is not null"))
    first = F.col(schema.fields[0].name)  # Spark reads no corrupt records without a column of the file
    read = read_leniently(spark, path, schema, glob).groupBy("file").agg(
        (F.count_if(first.isNotNull()) + F.count_if(first.isNull())).alias("n_rows"), F.count_if(F.col(CORRUPT).isNotNull()).alias("n_bad"))
    states = listed.join(read, "file", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    if rows_of is not None:
        states = states.join(rows_of.select("batch_no", "n_expected"), "batch_no", "left")
    else:
        states = states.withColumn("n_expected", F.when(~F.col("file").rlike(r"_final\.csv"), F.lit(batch_size)))
    # a file that has rows may still be cut in its last row; one without rows is empty if its bytes are a header line at most
    header = sum(len(f.name) + 1 for f in schema.fields) + 64
    reason = (F.when((F.col("n_rows") == 0) & (F.col("n_bytes") > header), F.lit("unreadable"))
               .when(F.col("n_rows") == 0, F.lit("empty"))
               .when(F.col("n_rows") < F.col("n_expected"), F.lit("truncated"))
               .when(F.col("n_bad") > 0, F.lit("bad_record")))
    return states.select("file", "batch_no", "n_bytes", "n_rows", reason.alias("reason"))


def catalog(states: DataFrame) -> DataFrame:
    """``batch_no`` and its place among all batches, quarantined ones included, so that their versions' numbers stay unused."""
    listed = states.select("batch_no").distinct()  # a row a batch
    return listed.withColumn("pos_numeric", F.row_number().over(Window.orderBy("batch_no"))).withColumn(
        "pos_lexical", F.row_number().over(Window.orderBy(F.col("batch_no").cast("string"))))


def quarantined(states: DataFrame) -> DataFrame:
    """Batches that are not to be used: ``batch_no``, ``n_files`` set aside, their ``reasons``."""
    return states.filter("reason is not null").groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n_files"), F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reasons"))


def sound_rows(rows: DataFrame, lost: DataFrame) -> DataFrame:
    """``rows`` (``read_leniently``) without those of quarantined batches; a part of a broken file is not a batch."""
    return rows.join(lost.select("batch_no"), "batch_no", "left_anti").drop("file", CORRUPT)
