"""Streaming: exact batches across micro-batches, restart, rejects, Kafka settings."""

import json
import os
import time

from pyspark.sql import functions as F

from tripspark.schemas import TOPIC_SCHEMA
from tripspark.streaming import pipeline, topic


def _trip(i):
    return json.dumps({"key": f"k{i}", "fare_amount": 5.0 + i, "pickup_datetime": "2013-07-02 19:54:00 UTC",
                       "pickup_longitude": -73.98, "pickup_latitude": 40.75, "dropoff_longitude": -73.95,
                       "dropoff_latitude": 40.78, "passenger_count": 1})


def _append_topic_file(spark, path, offsets, junk=()):
    rows = [(_trip(o), o, None) for o in offsets] + [(j, o, None) for o, j in junk]
    stage = path + "_stage"
    spark.createDataFrame(rows, TOPIC_SCHEMA).coalesce(1).write.mode("overwrite").parquet(stage)
    os.makedirs(path, exist_ok=True)
    for name in sorted(os.listdir(stage)):
        if name.endswith(".parquet"):
            target = os.path.join(path, f"part-{time.time_ns()}.parquet")
            os.replace(os.path.join(stage, name), target)
            t = time.time() + len(os.listdir(path))      # strictly increasing modification times
            os.utime(target, (t, t))


def _sizes(spark, out, n):
    return {r.batch_no: (r.n_rows, r.is_final) for r in pipeline.stream_batch_sizes(spark, out, n).collect()}


def test_exact_batches_across_micro_batches_and_restart(spark, tmp_out):
    src = tmp_out.replace("file:", "") + "/topic"
    _append_topic_file(spark, src, range(0, 10))
    _append_topic_file(spark, src, range(10, 15), junk=[(1000, "[1]"), (1001, "garbage")])
    _append_topic_file(spark, src, range(15, 27))
    t = topic.FileTopic(src, max_files_per_trigger=1)
    out, chk = f"{tmp_out}/batches", f"{tmp_out}/_chk"
    q = pipeline.run_batcher(spark, t, out, chk, 7)
    assert len(q.recentProgress) >= 3                     # one micro-batch per file
    assert _sizes(spark, out, 7) == {1: (7, False), 2: (7, False), 3: (7, False), 4: (6, True)}
    rows = pipeline.read_stream_batches(spark, out).select("row_no", "batch_no").collect()
    assert sorted((r.row_no, r.batch_no) for r in rows) == [(i, i // 7 + 1) for i in range(27)]
    assert spark.read.json(f"{out}/_rejects").count() == 2

    # restart on the same checkpoint: nothing new, nothing duplicated
    pipeline.run_batcher(spark, t, out, chk, 7)
    assert pipeline.read_stream_batches(spark, out).count() == 27

    # more data later: numbering continues, the short batch fills up
    _append_topic_file(spark, src, range(27, 31))
    pipeline.run_batcher(spark, t, out, chk, 7)
    assert _sizes(spark, out, 7) == {1: (7, False), 2: (7, False), 3: (7, False), 4: (7, False), 5: (3, True)}


def test_retried_micro_batch_is_idempotent(spark, tmp_out):
    b = pipeline.ExactBatcher(f"{tmp_out}/b", 4)
    df = spark.createDataFrame([(_trip(i), i, None) for i in range(6)], TOPIC_SCHEMA)
    b(df, 0)
    b(df, 0)                                   # same micro-batch again (task retry / restart)
    b(spark.createDataFrame([(_trip(i), i, None) for i in range(6, 9)], TOPIC_SCHEMA), 1)
    got = pipeline.read_stream_batches(spark, f"{tmp_out}/b")
    assert got.count() == 9
    assert sorted((r.row_no, r.batch_no) for r in got.collect()) == [(i, i // 4 + 1) for i in range(9)]


def test_replay_roundtrip_and_observed_counts(spark, tmp_out):
    raw_dir = tmp_out.replace("file:", "") + "/raw"
    rows = [(0, "a", "5.5", "2013-07-02 19:54:00 UTC", "-73.98", "40.75", "-73.95", "40.78", "2"),
            (1, "b", "", "2013-07-02 19:54:00 UTC", "-73.98", "40.75", "-73.95", "40.78", "2"),
            (2, None, "n/a", "2013-07-02 19:54:00 UTC", "-73.98", "40.75", "-73.95", "40.78", "2"),
            (3, None, "6.5", "2013-07-02 19:54:00 UTC", "-73.98", "40.75", "-73.95", "40.78", "3")]
    schema = ("row_no BIGINT, key STRING, fare_amount STRING, pickup_datetime STRING, pickup_longitude STRING, "
              "pickup_latitude STRING, dropoff_longitude STRING, dropoff_latitude STRING, passenger_count STRING")
    spark.createDataFrame(rows, schema).coalesce(1).write.option("header", True).csv(raw_dir)
    t = topic.FileTopic(f"{tmp_out}/topic")
    counters = pipeline.IngestCounters()
    pipeline.replay(spark, raw_dir, t, f"{tmp_out}/_chk", counters=counters)
    m = counters.totals()
    assert m == {"raw_rows": 4, "sent": 2, "skipped_missing_field": 1, "skipped_bad_value": 1}
    msgs = sorted((r.offset, json.loads(r.value)) for r in t.read(spark).collect())
    assert [o for o, _ in msgs] == [0, 3]
    assert msgs[1][1]["key"] == "row_3" and msgs[1][1]["passenger_count"] == 3


def test_counters_equal_the_topic_past_the_progress_history(spark, tmp_out):
    raw_dir = tmp_out.replace("file:", "") + "/raw_many"
    schema = ("row_no BIGINT, key STRING, fare_amount STRING, pickup_datetime STRING, pickup_longitude STRING, "
              "pickup_latitude STRING, dropoff_longitude STRING, dropoff_latitude STRING, passenger_count STRING")
    rows = [(i, f"k{i}", "5.5" if i % 5 else "", "2013-07-02 19:54:00 UTC", "-73.98", "40.75", "-73.95", "40.78", "1") for i in range(60)]
    spark.createDataFrame(rows, schema).repartition(12).write.option("header", True).csv(raw_dir)
    t = topic.FileTopic(f"{tmp_out}/topic_many")
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        counters = pipeline.IngestCounters()
        q = pipeline.replay(spark, raw_dir, t, f"{tmp_out}/_chk_many", max_files_per_trigger=1, counters=counters)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert len(q.recentProgress) <= 3 and len(counters.batches) == 12
    assert counters.totals() == {"raw_rows": 60, "sent": 48, "skipped_missing_field": 12, "skipped_bad_value": 0}
    assert t.read(spark).count() == 48


def test_fresh_checkpoint_continues_and_keeps_earlier_rows(spark, tmp_out):
    src = tmp_out.replace("file:", "")
    _append_topic_file(spark, f"{src}/t1", range(0, 5))
    _append_topic_file(spark, f"{src}/t1", range(5, 9))
    _append_topic_file(spark, f"{src}/t2", range(9, 14))
    out = f"{tmp_out}/restarted"
    pipeline.run_batcher(spark, topic.FileTopic(f"{src}/t1", 1), out, f"{tmp_out}/_chk1", 4)
    pipeline.run_batcher(spark, topic.FileTopic(f"{src}/t2", 1), out, f"{tmp_out}/_chk2", 4)
    rows = pipeline.read_stream_batches(spark, out).select("row_no", "batch_no").collect()
    assert sorted((r.row_no, r.batch_no) for r in rows) == [(i, i // 4 + 1) for i in range(14)]


def test_kafka_settings():
    src = topic.kafka_source_options(max_offsets_per_trigger=10000)
    assert src["subscribe"] == "taxi_fare_topic" and src["startingOffsets"] == "earliest"
    assert src["failOnDataLoss"] == "true"
    assert topic.kafka_source_options(fail_on_data_loss=False)["failOnDataLoss"] == "false"
    assert src["kafka.group.id"] == "taxi-fare-consumer-group-main" and src["maxOffsetsPerTrigger"] == "10000"
    sink = topic.kafka_sink_options()
    assert sink["kafka.retries"] == "5" and sink["kafka.linger.ms"] == "10"
    assert F is not None


def test_paced_replay_with_processing_time(spark, tmp_out):
    raw_dir = tmp_out.replace("file:", "") + "/raw_paced"
    rows = [(i, f"k{i}", "5.5", "2013-07-02 19:54:00 UTC", "-73.98", "40.75", "-73.95", "40.78", "1")
            for i in range(20)]
    schema = ("row_no BIGINT, key STRING, fare_amount STRING, pickup_datetime STRING, pickup_longitude STRING, "
              "pickup_latitude STRING, dropoff_longitude STRING, dropoff_latitude STRING, passenger_count STRING")
    spark.createDataFrame(rows, schema).repartition(2).write.option("header", True).csv(raw_dir)
    t = topic.FileTopic(f"{tmp_out}/topic_paced")
    q = pipeline.replay(spark, raw_dir, t, f"{tmp_out}/_chk_paced", max_files_per_trigger=1,
                        processing_time="500 milliseconds")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.offset for r in t.read(spark).collect()) == list(range(20))


def test_multiple_of_n_stream_has_no_final_batch(spark, tmp_out):
    b = pipeline.ExactBatcher(f"{tmp_out}/nm", 4)
    b(spark.createDataFrame([(_trip(i), i, None) for i in range(5)], TOPIC_SCHEMA), 0)
    b(spark.createDataFrame([(_trip(i), i, None) for i in range(5, 8)], TOPIC_SCHEMA), 1)
    assert _sizes(spark, f"{tmp_out}/nm", 4) == {1: (4, False), 2: (4, False)}


def test_a_single_file_is_parsed_by_several_tasks(spark, tmp_out, monkeypatch):
    """A micro-batch that comes as one split is dealt out before its messages are parsed."""
    seen = []
    monkeypatch.setattr(pipeline.ExactBatcher, "_write", lambda self, df, batch_id, start: seen.append(df._jdf.queryExecution().withCachedData().toString()))
    one = spark.range(20).selectExpr("id AS offset", "'{}' AS value").coalesce(1)
    pipeline.ExactBatcher(f"{tmp_out}/b", 5)(one, 0)
    assert "hashpartitioning(offset" in seen[0]
