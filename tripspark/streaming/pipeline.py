"""Streaming stages: replay trips to a topic, cut exact batches, score requests.

* ``replay``: raw CSV files → typing/validation → JSON → topic, with ingest
  counters published through ``observe`` (R1, A2).
* ``ExactBatcher``: topic → decoded trips → batches of exactly N records written
  as CSV folders (R2, K3). Micro-batch sizes need not be N: each micro-batch
  numbers its rows from a committed counter, so a batch can collect rows from
  two micro-batches. A retried micro-batch recomputes the same numbers and
  overwrites its own folder (idempotent, R4). The last short batch is the
  ``final`` one once the stream is drained (K4, R5).
* ``score_stream``: request stream → status → features → version model (R6).
"""

from __future__ import annotations

import threading
import uuid

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..functions import codec
from ..operators import batching, ingest, scoring
from ..schemas import TRIP_COLUMNS, TRIP_SCHEMA
from ..session import path_exists
from ..sources.files import RAW_FILE_SCHEMA, NULL_MARKER
from .manifest import EVERY, Manifest
from .topic import FileTopic, run_available_now


class IngestCounters(StreamingQueryListener):
    """The observed ``ingest`` counters of every micro-batch of a replay, keyed by its id (A2).

    A listener hears of each micro-batch when it ends; the query's own progress
    history keeps only the last ones.
    """

    def __init__(self) -> None:
        self.batches: dict[int, dict[str, int]] = {}
        self.last = -1
        self._ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        m = p.observedMetrics.get("ingest")
        if m is not None:
            self.batches[p.batchId] = {k: int(v or 0) for k, v in m.asDict().items()}

    def onQueryTerminated(self, event) -> None:
        self._ended.set()

    def totals(self, wait_s: float = 60) -> dict[str, int]:
        """Sums over all micro-batches; raises if the end or a micro-batch was not heard of."""
        if not self._ended.wait(wait_s):
            raise TimeoutError("the replay's end was not reported")
        missing = set(range(max(self.batches, default=-1) + 1)) - set(self.batches)
        if missing:
            raise RuntimeError(f"no counters for micro-batches {sorted(missing)}")
        out: dict[str, int] = {}
        for m in self.batches.values():
            for k, v in m.items():
                out[k] = out.get(k, 0) + v
        return out


def raw_stream(spark: SparkSession, raw_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = (spark.readStream.schema(RAW_FILE_SCHEMA).option("header", True)
         .option("nullValue", NULL_MARKER))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.csv(raw_dir)


def replay(spark: SparkSession, raw_dir: str, topic, checkpoint: str, max_files_per_trigger: int | None = None,
           processing_time: str | None = None, run: bool = True, counters: IngestCounters | None = None):
    """Replay raw trips into ``topic`` (R1). ``processing_time`` paces triggers like the sleep did.

    Returns the (finished, when ``run``) streaming query. ``counters`` hears the observed ``ingest``
    metrics (raw rows, sent, skipped per reason) of every micro-batch of a run.
    """
    typed = ingest.type_trips(raw_stream(spark, raw_dir, max_files_per_trigger))
    r = F.col("reject_reason")
    observed = typed.observe("ingest", F.count(F.lit(1)).alias("raw_rows"),
                             F.count_if(r.isNull()).alias("sent"),
                             F.count_if(r == ingest.MISSING_FIELD).alias("skipped_missing_field"),
                             F.count_if(r == ingest.BAD_VALUE).alias("skipped_bad_value"))
    msgs = ingest.accepted(observed).select(codec.encode().alias("value"), F.col("row_no").alias("offset"),
                                            F.current_timestamp().alias("timestamp"))
    writer = topic.write_stream(msgs, checkpoint)
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    if not run:
        return writer
    if counters is not None:
        spark.streams.addListener(counters)
    try:
        query = run_available_now(writer, "replay")
        if counters is not None:
            counters.totals()  # waits for the last report
        return query
    finally:
        if counters is not None:
            spark.streams.removeListener(counters)


class ExactBatcher:
    """``foreachBatch`` function cutting a message stream into N-record batch folders.

    Output layout: ``<out>/stream=<id>/mb=<micro batch>/batch_no=<n>/part-*.csv`` with the
    trip columns and ``row_no`` (= arrival offset); ``<out>/_manifest`` logs where each
    micro-batch's numbers start and end, compacted every ``manifest_every`` entries. ``stream`` names the
    checkpoint the micro-batch ids belong to: a run with another checkpoint writes beside the
    earlier rows and continues their numbering (R4, Z8). One stream writes to ``out`` at a
    time. Non-object messages go to ``<out>/_rejects`` instead of stopping the stream.
    """

    def __init__(self, out: str, batch_size: int, index_buckets: int | None = None, stream: str = "0",
                 manifest_every: int = EVERY):
        if batch_size < 1:
            raise ValueError("batch_size must be positive")
        self.out = out.rstrip("/")
        self.batch_size = int(batch_size)
        self.index_buckets = index_buckets
        self.stream = stream
        self.manifest_every = manifest_every

    def manifest(self, spark: SparkSession) -> Manifest:
        return Manifest(spark, f"{self.out}/_manifest", self.manifest_every)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        start = self.manifest(spark).start(self.stream, batch_id)
        # A micro-batch is bounded by the trigger limits; it is read by several
        # jobs below (rejects, count, index, write), so keep it, parsed once, for their span.
        # Few large files give few tasks, so rows are dealt out before they are parsed.
        spread = df.select("offset", "value").repartition("offset", "value")
        kept = spread.select("offset", "value", codec.as_object("value", TRIP_SCHEMA).alias("t")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._write(kept, batch_id, start)
        finally:
            kept.unpersist()

    def _write(self, df: DataFrame, batch_id: int, start: int) -> None:
        spark = df.sparkSession
        place = f"stream={self.stream}/mb={batch_id}"
        (df.filter(F.col("t").isNull()).select("offset", "value")
           .write.mode("overwrite").json(f"{self.out}/_rejects/{place}"))
        trips = df.filter(F.col("t").isNotNull()).select(F.col("offset").alias("row_no"), "t.*")
        n_rows = trips.count()
        if n_rows:
            idx = batching.dense_index(trips, "row_no", out="_i", num_buckets=self.index_buckets)
            rows = idx.withColumn("batch_no", (F.expr(f"({start} + _i) div {self.batch_size}") + 1).cast("int"))
            (rows.select(*TRIP_COLUMNS, "row_no", "batch_no").sortWithinPartitions("batch_no", "row_no")
                 .write.mode("overwrite").partitionBy("batch_no").option("header", True)
                 .csv(f"{self.out}/{place}"))
        self.manifest(spark).add(self.stream, batch_id, start, n_rows)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name a checkpoint folder gives its stream; made on first use and kept beside it."""
    path = f"{checkpoint.rstrip('/')}_stream"
    if not path_exists(spark, f"{path}/_SUCCESS") or not path_exists(spark, checkpoint):
        spark.createDataFrame([(uuid.uuid4().hex,)], "id STRING").coalesce(1).write.mode("overwrite").json(path)
    return spark.read.schema("id STRING").json(path).first()["id"]


def run_batcher(spark: SparkSession, topic: FileTopic, out: str, checkpoint: str, batch_size: int, manifest_every: int = EVERY):
    """Drain the topic into exact batches with ``availableNow``."""
    batcher = ExactBatcher(out, batch_size, stream=stream_id(spark, checkpoint), manifest_every=manifest_every)
    writer = topic.read_stream(spark).writeStream.foreachBatch(batcher).option("checkpointLocation", checkpoint)
    return run_available_now(writer, "batcher")


def read_stream_batches(spark: SparkSession, out: str) -> DataFrame:
    """Batch rows written by the batcher: trip columns, ``row_no``, ``stream``, ``mb``, ``batch_no``."""
    schema = StructType([*TRIP_SCHEMA.fields, StructField("row_no", LongType()), StructField("stream", StringType()),
                         StructField("mb", LongType()), StructField("batch_no", IntegerType())])
    return spark.read.schema(schema).option("header", True).option("basePath", out).csv(f"{out}/stream=*/mb=*")


def stream_batch_sizes(spark: SparkSession, out: str, batch_size: int) -> DataFrame:
    """Rows per batch across micro-batches; the short last batch is the final one (A3, K4)."""
    return batching.batch_sizes(read_stream_batches(spark, out), batch_size)


def score_stream(spark: SparkSession, requests: DataFrame, registry: DataFrame,
                 models: dict[str, PipelineModel], out: str, checkpoint: str):
    """Score a request stream into ``out`` (parquet, one folder per micro-batch)."""

    def _score(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)  # read once, not once for each model
        try:
            scoring.score(scoring.request_status(kept, registry), models).write.mode("overwrite").parquet(f"{out}/mb={batch_id}")
        finally:
            kept.unpersist()

    writer = requests.writeStream.foreachBatch(_score).option("checkpointLocation", checkpoint)
    return run_available_now(writer, "score_stream")
