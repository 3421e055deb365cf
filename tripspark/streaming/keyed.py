"""Count batching as keyed state: the next number of each topic partition lives in the state store.

A topic partition is a sequence that one reader consumes in order, so batches of N records are cut for each partition apart, its next number a
value in the state store: nothing else is read to go on after a restart. With one
partition the batches are those of ``ExactBatcher``; several are numbered side by side.

The state takes counts, not rows: each task counts its rows of a partition, the state adds them up and gives the number the micro-batch starts with.
The rows get their places in the order of their offsets from buckets of the offset, counted and ranked side by side, so no task
holds a partition's rows. A micro-batch has a folder of its own; a retry starts from the same state and overwrites it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..functions import codec
from ..operators import batching
from ..schemas import TRIP_COLUMNS, TRIP_SCHEMA
from ..session import make_file
from .pipeline import stream_id
from .topic import run_available_now

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
START_SCHEMA = StructType([StructField("partition", IntegerType()), StructField("start", LongType())])


class NextNumber(StatefulProcessor):
    """The number with which a partition's rows of a micro-batch start, from their counts and where the state stands."""

    def __init__(self, batch_size: int):
        if batch_size < 1:
            raise ValueError("batch_size must be positive")
        self.batch_size = batch_size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._next = handle.getValueState("next", StructType([StructField("n", LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start = int(self._next.get()[0]) if self._next.exists() else 0
        self._next.update((start + sum(int(r["n"].sum()) for r in rows),))
        yield pd.DataFrame({"partition": pd.array([key[0]], "Int32"), "start": [start]})

    def close(self) -> None:
        pass


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for v in pc.value_counts(batch.column("partition")).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array([v["values"]], pa.int32()), pa.array([v["counts"]], pa.int64())], ["partition", "n"])


def keyed_batches(messages: DataFrame, batch_size: int, partition: str | None = None) -> DataFrame:
    """A stream of messages (``value``, ``offset``) as trips ``t`` with ``partition`` and ``row_no`` (the offset), and beside them, for each
    partition of a micro-batch, a row with ``start``, its first number (else NULL). ``numbered`` makes batches of a micro-batch.

    ``partition``: the column with the topic's partition; without one the topic has a single partition, 0. Messages that are not objects are left out.
    """
    key = F.col(partition).cast("int") if partition else F.lit(0)
    # few large files give few tasks, so messages are dealt out before they are parsed
    dealt = messages.select(key.alias("partition"), "offset", "value").repartition("offset", "value")
    trips = dealt.select("partition", F.col("offset").alias("row_no"), codec.as_object("value", TRIP_SCHEMA).alias("t")).filter("t is not null")
    starts = (trips.select("partition").mapInArrow(_counted, "partition int, n long").groupBy("partition")
              .transformWithStateInPandas(statefulProcessor=NextNumber(batch_size), outputStructType=START_SCHEMA, outputMode="Append", timeMode="None"))
    return trips.withColumn("start", F.lit(None).cast("long")).unionByName(starts, allowMissingColumns=True)


def numbered(micro_batch: DataFrame, batch_size: int) -> DataFrame:
    """The trips of a (persisted) micro-batch of ``keyed_batches`` with ``partition``, ``batch_no`` and ``row_no``."""
    starts = micro_batch.filter("start is not null").select(F.col("partition").alias("_p"), "start")  # a row a partition
    rows = micro_batch.filter("start is null").select("partition", "row_no", "t")
    tie = F.to_json("t")
    keyed = batching.key_buckets(rows, "row_no", batching.index_buckets(rows)).withColumns({"_tie": F.xxhash64(F.lit(0), tie), "_tie2": F.xxhash64(F.lit(1), tie)})
    counts = keyed.groupBy("partition", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("partition").orderBy("_bucket")) - F.col("_n")  # a row a bucket
    offsets = counts.join(F.broadcast(starts), F.col("partition").eqNullSafe(F.col("_p"))).select("_p", F.col("_bucket").alias("_b"), (before + F.col("start")).alias("_first"))
    local = F.row_number().over(Window.partitionBy("partition", "_bucket").orderBy(F.col("row_no").asc_nulls_last(), "_tie", "_tie2")) - 1
    placed = keyed.withColumn("_local", local).join(offsets, F.col("partition").eqNullSafe(F.col("_p")) & (F.col("_bucket") == F.col("_b")))
    batch_no = (F.expr(f"(_first + _local) div {int(batch_size)}") + 1).cast("int")
    return placed.select("partition", batch_no.alias("batch_no"), "row_no", "t.*")


def run_keyed_batches(spark: SparkSession, messages: DataFrame, out: str, checkpoint: str, batch_size: int, partition: str | None = None):
    """Drain ``messages`` into CSV folders ``stream=<id>/mb=<micro batch>/partition=<p>/batch_no=<n>/``; the state store below ``checkpoint``
    keeps the numbers, ``stream`` names the checkpoint."""
    out = out.rstrip("/")
    place = f"{out}/stream={stream_id(spark, checkpoint)}"
    make_file(spark, f"{out}/_batches")  # a folder without batches can be read, too

    def write(df: DataFrame, batch_id: int) -> None:
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)  # parsed once for starts, buckets, counts and ranks
        try:
            (numbered(kept, batch_size).sortWithinPartitions("partition", "batch_no", "row_no").write.mode("overwrite").option("header", True)
             .partitionBy("partition", "batch_no").csv(f"{place}/mb={batch_id}"))
        finally:
            kept.unpersist()

    conf = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(conf)
    spark.conf.set(conf, PROVIDER)  # state of this kind needs it; a query keeps the provider it started with
    try:
        writer = keyed_batches(messages, batch_size, partition).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        return run_available_now(writer, "keyed_batches")
    finally:
        spark.conf.set(conf, before)


def read_keyed_batches(spark: SparkSession, out: str) -> DataFrame:
    schema = StructType([StructField("row_no", LongType()), *TRIP_SCHEMA.fields, StructField("stream", StringType()), StructField("mb", LongType()),
                         StructField("partition", IntegerType()), StructField("batch_no", IntegerType())])
    return spark.read.schema(schema).option("header", True).csv(out).select("partition", "batch_no", "row_no", *TRIP_COLUMNS)
