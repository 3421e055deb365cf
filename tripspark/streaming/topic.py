"""Message topics: Kafka, or a file-backed twin with the same columns (S4, S4f, K2).

The Kafka connector is not on this machine's classpath, so the Kafka variants
only build the reader / writer with the original's settings; tests and the
registered queries use the file-backed topic (a parquet folder written by a
streaming file sink, columns ``value, offset, timestamp``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TOPIC_SCHEMA

# Topic settings of the original pipeline.
TOPIC = "taxi_fare_topic"
BOOTSTRAP = "localhost:9092"
GROUP_ID = "taxi-fare-consumer-group-main"
PRODUCER_RETRIES = 5
PRODUCER_LINGER_MS = 10


def kafka_source_options(bootstrap: str = BOOTSTRAP, topic: str = TOPIC, group_id: str = GROUP_ID,
                         starting: str = "earliest", max_offsets_per_trigger: int | None = None,
                         min_offsets_per_trigger: int | None = None,
                         max_trigger_delay: str | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``.

    ``min/maxOffsetsPerTrigger`` bound micro-batch sizes; exact N-record batches
    cut by the batcher regardless of micro-batch boundaries. Records that aged out
    before they were read stop the stream unless ``fail_on_data_loss`` is off.
    """
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting,
            "kafka.group.id": group_id, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_offsets_per_trigger:
        opts["minOffsetsPerTrigger"] = str(min_offsets_per_trigger)
    if max_trigger_delay:
        opts["maxTriggerDelay"] = max_trigger_delay
    return opts


def kafka_sink_options(bootstrap: str = BOOTSTRAP, topic: str = TOPIC) -> dict[str, str]:
    """Options for ``writeStream.format("kafka")`` with the producer's retries and linger (K2)."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic,
            "kafka.retries": str(PRODUCER_RETRIES), "kafka.linger.ms": str(PRODUCER_LINGER_MS)}


@dataclass
class KafkaTopic:
    bootstrap: str = BOOTSTRAP
    topic: str = TOPIC
    group_id: str = GROUP_ID

    def read_stream(self, spark: SparkSession, **opts) -> DataFrame:
        src = spark.readStream.format("kafka").options(
            **kafka_source_options(self.bootstrap, self.topic, self.group_id, **opts)).load()
        # Arrival order key: partition, then offset (exact as a double for < 2**11 partitions).
        return src.select(F.col("value").cast("string").alias("value"),
                          (F.col("partition").cast("long") * F.lit(1 << 42) + F.col("offset")).alias("offset"),
                          "timestamp")

    def write_stream(self, df: DataFrame, checkpoint: str):
        return (df.select(F.col("value").cast("string").alias("value"))
                  .writeStream.format("kafka").options(**kafka_sink_options(self.bootstrap, self.topic))
                  .option("checkpointLocation", checkpoint))


@dataclass
class FileTopic:
    """Directory-backed topic with the Kafka source's columns.

    Producer micro-batches are written in parallel, several files each. Files of
    later micro-batches are read later; inside one micro-batch the consumer
    orders by ``offset``, the way it orders rows of several Kafka partitions.
    """

    path: str
    max_files_per_trigger: int | None = None

    def read_stream(self, spark: SparkSession) -> DataFrame:
        r = spark.readStream.schema(TOPIC_SCHEMA)
        if self.max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(self.max_files_per_trigger))
        return r.parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(TOPIC_SCHEMA).parquet(self.path)

    def write_stream(self, df: DataFrame, checkpoint: str):
        return (df.select("value", "offset", "timestamp")
                  .writeStream.format("parquet").option("path", self.path)
                  .option("checkpointLocation", checkpoint))


def run_available_now(writer, query_name: str | None = None, timeout_s: float | None = None):
    """Start a stream writer with ``availableNow``: drain what is there, then stop.

    Runs until the source is drained; ``timeout_s`` sets a limit.
    """
    w = writer.trigger(availableNow=True)
    if query_name:
        # unique per run: two active queries may not share a name
        w = w.queryName(f"{query_name}_{uuid.uuid4().hex[:8]}")
    q = w.start()
    if timeout_s is None:
        q.awaitTermination()
    else:
        q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream {query_name or q.id} did not finish in {timeout_s}s")
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return q
