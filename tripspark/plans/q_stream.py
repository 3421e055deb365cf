"""Registered queries: streaming stages run with ``availableNow`` and read back (§2.9, S4f, K2-K4).

Every query uses fresh folders under the shared scratch folder for its topic,
outputs and checkpoints.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from .. import fixture
from ..functions import codec
from ..operators import batching, training
from ..schemas import TRIP_COLUMNS, TRIP_SCHEMA
from ..session import delete, list_dir, scratch_path
from ..sources import models as registry
from ..streaming import keyed, lifecycle, pipeline
from ..streaming.topic import FileTopic, run_available_now
from . import frames
from .oracle_base import BATCH_SIZE_SQL, with_pipeline
from .q_scoring import FARE_CTES, REQ_CTES
from .registry import query

TRIP_SQL = ", ".join(TRIP_COLUMNS)


def _replayed_topic(spark, sf_dir, name):
    base = scratch_path(spark, name)
    topic = FileTopic(f"{base}/topic")
    counters = pipeline.IngestCounters()
    pipeline.replay(spark, fixture.raw_source_path(spark, sf_dir), topic, f"{base}/_chk_replay", counters=counters)
    return base, topic, counters


@query("stream_topic_roundtrip", with_pipeline(f"SELECT row_no, {TRIP_SQL} FROM sent"))
def stream_topic_roundtrip(spark, sf_dir):
    """Raw CSV stream → validated JSON messages → topic → consumer stream → typed trips (R1, K1, K2, S4f, S5)."""
    base, topic, _ = _replayed_topic(spark, sf_dir, "stream_roundtrip")
    decoded = (topic.read_stream(spark)
               .select(F.col("offset").alias("row_no"), codec.decode("value", TRIP_SCHEMA).alias("t"))
               .select("row_no", "t.*"))
    writer = (decoded.writeStream.format("parquet").option("path", f"{base}/consumed")
              .option("checkpointLocation", f"{base}/_chk_consume"))
    run_available_now(writer, "consume")
    return spark.read.parquet(f"{base}/consumed").select("row_no", *TRIP_COLUMNS)


@query("stream_ingest_funnel", with_pipeline(
    "SELECT count(*) AS raw_rows, CAST(count_if(reject_reason IS NULL) AS BIGINT) AS sent, "
    "CAST(count_if(reject_reason = 'missing_field') AS BIGINT) AS skipped_missing_field, "
    "CAST(count_if(reject_reason = 'bad_value') AS BIGINT) AS skipped_bad_value FROM typed2"))
def stream_ingest_funnel(spark, sf_dir):
    """Sent / skipped counters of the replay stream, published with ``observe`` (A2 on a stream)."""
    base, _, counters = _replayed_topic(spark, sf_dir, "stream_funnel")
    m = counters.totals()
    delete(spark, base)
    cols = ["raw_rows", "sent", "skipped_missing_field", "skipped_bad_value"]
    return spark.createDataFrame([tuple(int(m.get(c, 0)) for c in cols)], ", ".join(f"{c} BIGINT" for c in cols))


def _stream_batches(spark, sf_dir):
    base, topic, _ = _replayed_topic(spark, sf_dir, "stream_batches")
    n = batching.fixture_batch_size(spark, sf_dir)
    pipeline.run_batcher(spark, topic, f"{base}/batches", f"{base}/_chk_batcher", n)
    return f"{base}/batches", n


@query("stream_batches_csv", with_pipeline("SELECT row_no, batch_no, fare_amount, key FROM b"))
def stream_batches_csv(spark, sf_dir):
    """Topic stream cut into exact N-record batches, written as CSV folders (R2, K3)."""
    out, _ = _stream_batches(spark, sf_dir)
    return pipeline.read_stream_batches(spark, out).select("row_no", "batch_no", "fare_amount", "key")


@query("stream_batches_final", with_pipeline(
    f"SELECT batch_no, count(*) AS n_rows, count(*) < {BATCH_SIZE_SQL} AS is_final FROM b GROUP BY batch_no"))
def stream_batches_final(spark, sf_dir):
    """Batch sizes after draining; the short last batch is flagged final."""
    out, n = _stream_batches(spark, sf_dir)
    return pipeline.stream_batch_sizes(spark, out, n)


@query("stream_restart_batches", with_pipeline(
    f"SELECT batch_no, count(*) AS n_rows, count(DISTINCT row_no) AS n_distinct, count(*) < {BATCH_SIZE_SQL} AS is_final "
    "FROM (SELECT row_no, batch_no FROM b) GROUP BY batch_no"))
def stream_restart_batches(spark, sf_dir):
    """Two runs with a checkpoint each, several triggers long, into one folder: nothing lost, numbering goes on."""
    base = scratch_path(spark, "stream_restart")
    n = batching.fixture_batch_size(spark, sf_dir)
    sent = frames.sent(spark, sf_dir).select(codec.encode().alias("value"), F.col("row_no").alias("offset"), F.current_timestamp().alias("timestamp"))
    half = sent.agg(F.avg("offset")).first()[0] or 0
    for name, part in (("first", sent.filter(F.col("offset") < half)), ("second", sent.filter(F.col("offset") >= half))):
        part.repartition(6, "offset").write.parquet(f"{base}/{name}")
        pipeline.run_batcher(spark, FileTopic(f"{base}/{name}", max_files_per_trigger=2), f"{base}/batches", f"{base}/_chk_{name}", n)
    rows = pipeline.read_stream_batches(spark, f"{base}/batches")
    return batching.batch_sizes(rows, n).join(rows.groupBy("batch_no").agg(F.count_distinct("row_no").alias("n_distinct")), "batch_no")


@query("score_stream", with_pipeline(
    "SELECT model_version, CASE WHEN status = 'accepted' THEN 'ok' ELSE status END AS status, "
    "count(*) AS n_requests FROM st GROUP BY ALL", REQ_CTES))
def score_stream(spark, sf_dir):
    """Request stream scored by version models, every request with a status."""
    base = scratch_path(spark, "score_stream")
    frames.requests(spark, sf_dir).write.mode("overwrite").parquet(f"{base}/requests")
    req_schema = "request_id BIGINT, model_version STRING, value STRING"
    stream = spark.readStream.schema(req_schema).option("maxFilesPerTrigger", "4").parquet(f"{base}/requests")
    models_dir, _ = frames.trained_models(spark, sf_dir)
    reg, models = registry.load_expected(spark, models_dir, 3)
    pipeline.score_stream(spark, stream, registry.loaded_versions(reg), models, f"{base}/scored", f"{base}/_chk")
    scored = spark.read.parquet(f"{base}/scored/mb=*")
    return scored.groupBy("model_version", "status").agg(F.count(F.lit(1)).alias("n_requests"))



# --- runs that go on -------------------------------------------------------------------------

#: Seconds without rows after which the registered streams end (the original waits for 60).
IDLE_SECONDS = 4.0


def _halves(rows, column):
    half = rows.agg(F.avg(column)).first()[0] or 0
    return rows.filter(F.col(column) < half), rows.filter(F.col(column) >= half)


@query("stream_idle_end", with_pipeline(
    f"SELECT batch_no, count(*) AS n_rows, count(DISTINCT row_no) AS n_distinct, count(*) < {BATCH_SIZE_SQL} AS is_final FROM (SELECT row_no, batch_no FROM b) GROUP BY batch_no"))
def stream_idle_end(spark, sf_dir):
    """A consumer that runs on while messages arrive and ends by itself after a silence; the short last batch is final."""
    base, n = scratch_path(spark, "stream_idle"), batching.fixture_batch_size(spark, sf_dir)
    sent = frames.sent(spark, sf_dir).select(codec.encode().alias("value"), F.col("row_no").alias("offset"), F.current_timestamp().alias("timestamp"))
    first, second = _halves(sent, "offset")
    topic = FileTopic(f"{base}/topic")
    first.repartition(3, "offset").write.parquet(topic.path)
    batcher = pipeline.ExactBatcher(f"{base}/batches", n, stream=pipeline.stream_id(spark, f"{base}/_chk"))

    def consume(df, batch_id):
        batcher(df, batch_id)
        if batch_id == 0:  # more messages while the consumer runs
            second.repartition(3, "offset").write.mode("append").parquet(topic.path)

    lifecycle.run_until_idle(spark, topic.read_stream(spark).writeStream.foreachBatch(consume).option("checkpointLocation", f"{base}/_chk"), IDLE_SECONDS)
    rows = pipeline.read_stream_batches(spark, f"{base}/batches")
    return batching.batch_sizes(rows, n).join(rows.groupBy("batch_no").agg(F.count_distinct("row_no").alias("n_distinct")), "batch_no")


@query("stream_compacted_restart", with_pipeline(
    f"SELECT batch_no, count(*) AS n_rows, count(*) < {BATCH_SIZE_SQL} AS is_final, true AS log_is_short FROM b GROUP BY batch_no"))
def stream_compacted_restart(spark, sf_dir):
    """Eight micro-batches, then a restart with a fresh checkpoint: numbers go on from a log that is compacted every three entries."""
    base, n = scratch_path(spark, "stream_compacted"), batching.fixture_batch_size(spark, sf_dir)
    sent = frames.sent(spark, sf_dir).select(codec.encode().alias("value"), F.col("row_no").alias("offset"), F.current_timestamp().alias("timestamp"))
    for name, part in zip(("first", "second"), _halves(sent, "offset")):
        part.repartition(4, "offset").write.parquet(f"{base}/{name}")
        pipeline.run_batcher(spark, FileTopic(f"{base}/{name}", max_files_per_trigger=1), f"{base}/batches", f"{base}/_chk_{name}", n, manifest_every=3)
    short = len(list_dir(spark, f"{base}/batches/_manifest")) <= 6
    return pipeline.stream_batch_sizes(spark, f"{base}/batches", n).withColumn("log_is_short", F.lit(short))


@query("score_stream_refresh", with_pipeline("""
SELECT request_id, model_version, CASE WHEN early AND model_version <> 'v1' THEN 'unknown_model' WHEN status = 'accepted' THEN 'ok' ELSE status END AS status,
  CASE WHEN NOT early OR model_version = 'v1' THEN predicted_fare END AS predicted_fare, CASE WHEN early THEN 'v1' ELSE all_versions END AS known
FROM (SELECT *, request_id < (SELECT avg(row_no) FROM sent) AS early, (SELECT string_agg('v' || v, ',' ORDER BY v) FROM coef) AS all_versions FROM fare)""", FARE_CTES))
def score_stream_refresh(spark, sf_dir):
    """Requests scored by a stream that runs on while versions 2 and 3 are published: they count from the next micro-batch."""
    base = scratch_path(spark, "score_refresh")
    trained, summary = frames.trained_models(spark, sf_dir, kind="lr_plain", input_cols=["distance_km"])
    versions = sorted(r.version for r in summary.filter("status = 'saved'").select("version").collect())

    def publish(v):
        PipelineModel.load(training.model_path(trained, v)).write().overwrite().save(training.model_path(f"{base}/models", v))

    publish(versions[0])
    first, second = _halves(frames.requests(spark, sf_dir), "request_id")
    first.write.parquet(f"{base}/requests")
    shelf = lifecycle.ModelShelf(spark, f"{base}/models", f"{base}/_models")
    score = lifecycle.scoring_batch(shelf, f"{base}/scored")

    def serve(df, batch_id):
        score(df, batch_id)
        if batch_id == 0:  # the trainer ends while the service runs, then more requests come
            for v in versions[1:]:
                publish(v)
            second.write.mode("append").parquet(f"{base}/requests")

    stream = spark.readStream.schema("request_id BIGINT, model_version STRING, value STRING").parquet(f"{base}/requests")
    try:
        lifecycle.run_until_idle(spark, stream.writeStream.foreachBatch(serve).option("checkpointLocation", f"{base}/_chk"), IDLE_SECONDS)
    finally:
        shelf.close()
    return spark.read.parquet(f"{base}/scored/mb=*").select("request_id", "model_version", "status", "predicted_fare", F.array_join("known", ",").alias("known"))


@query("stream_state_batches", with_pipeline("SELECT row_no, batch_no, fare_amount, key FROM b"))
def stream_state_batches(spark, sf_dir):
    """Exact batches by keyed state, over three triggers and a restart from the same checkpoint; the next number is in the state store."""
    base, n = scratch_path(spark, "stream_state"), batching.fixture_batch_size(spark, sf_dir)
    sent = frames.sent(spark, sf_dir).select(codec.encode().alias("value"), F.col("row_no").alias("offset"), F.current_timestamp().alias("timestamp"))
    first, second = _halves(sent, "offset")
    topic = FileTopic(f"{base}/topic", max_files_per_trigger=2)

    def arrive(part):
        part.repartition(2, "offset").write.mode("append").parquet(topic.path)

    def consume():
        keyed.run_keyed_batches(spark, topic.read_stream(spark), f"{base}/batches", f"{base}/_chk", n)

    for part in _halves(first, "offset"):
        arrive(part)
    consume()
    arrive(second)
    consume()
    return keyed.read_keyed_batches(spark, f"{base}/batches").select("row_no", "batch_no", "fare_amount", "key")
