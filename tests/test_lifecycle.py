"""Log compaction, end by silence, refreshed models."""
import random
import threading
import time

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tripspark.session import list_dir
from tripspark.streaming import lifecycle, manifest


def test_a_long_run_restarts_from_one_table(spark, tmp_out):
    """A thousand entries with retries: every start as in a plain dictionary, few names, one table."""
    log = manifest.Manifest(spark, f"{tmp_out}/log", every=100)
    r, at = random.Random(3), 0
    for k in range(1000):
        assert log.start("a", k) == at
        rows = r.randint(0, 9)
        log.add("a", k, at, rows)
        if k % 97 == 0:  # a retry: same start, same entry
            assert log.start("a", k) == at
            log.add("a", k, at, rows)
        at += rows
    names = [n for n, _ in list_dir(spark, f"{tmp_out}/log")]
    assert sum(n.startswith("c-") for n in names) == 1 and len(names) <= 103
    again = manifest.Manifest(spark, f"{tmp_out}/log", every=100)
    assert again.start("a", 1000) == at and again.opened == 0       # the entry before is listed
    assert again.start("b", 0) == at and again.opened == 1          # a fresh checkpoint: one table and the names
    again.add("b", 0, at, 5)
    assert again.start("b", 1) == at + 5 and again.start("c", 0) == at + 5 and again.end() == at + 5
    assert again.start("b", 0) == at                                # the retry of a stream's first micro-batch


def test_retries_that_change_an_entry_and_a_lost_table(spark, tmp_out):
    log = manifest.Manifest(spark, f"{tmp_out}/log", every=3)
    for k in range(5):
        log.add("a", k, 10 * k, 10)
    log.add("a", 4, 40, 7)
    assert log.start("a", 5) == 47 and log.end() == 47
    spark.createDataFrame([("a", 99, 0, 9999)], manifest.SCHEMA).write.json(f"{tmp_out}/half/c")   # a table without its mark does not count
    spark.sparkContext._jvm.java.io.File(f"{tmp_out.replace('file:', '')}/log/c-000000000099").mkdirs()
    assert log.end() == 47
    with pytest.raises(ValueError):
        manifest.Manifest(spark, tmp_out, every=1)


def test_run_until_idle_waits_for_late_rows(spark, tmp_out):
    path = tmp_out.replace("file:", "") + "/in"
    spark.range(5).write.parquet(path)
    late = threading.Timer(2.0, lambda: spark.range(5, 12).coalesce(1).write.mode("append").parquet(path))
    writer = spark.readStream.schema("id long").parquet(path).writeStream.format("parquet").option("path", f"{tmp_out}/out").option("checkpointLocation", f"{tmp_out}/_chk")
    late.start()
    began = time.monotonic()
    query, rows = lifecycle.run_until_idle(spark, writer, idle_s=6.0)
    assert not query.isActive and rows == 12 and time.monotonic() - began >= 6.0
    assert spark.read.parquet(f"{tmp_out}/out").count() == 12


def test_run_until_idle_reports_failures(spark, tmp_out):
    spark.range(5).write.parquet(f"{tmp_out}/in")

    def fail(df, batch_id):
        raise ValueError("broken sink")
    writer = spark.readStream.schema("id long").parquet(f"{tmp_out}/in").writeStream.foreachBatch(fail).option("checkpointLocation", f"{tmp_out}/_chk")
    with pytest.raises(Exception, match="broken sink"):
        lifecycle.run_until_idle(spark, writer, idle_s=30.0)


def _publish(spark, base, v, slope):
    rows = spark.createDataFrame([(float(i), slope * i + 1.0) for i in range(10)], "distance_km double, fare_amount double")
    stages = [VectorAssembler(inputCols=["distance_km"], outputCol="features"), LinearRegression(labelCol="fare_amount")]
    Pipeline(stages=stages).fit(rows).write().overwrite().save(f"{base}/models/fare_model_v{v}")


def test_a_retry_scores_with_the_models_of_its_first_try(spark, tmp_out):
    _publish(spark, tmp_out, 1, 2.0)
    shelf = lifecycle.ModelShelf(spark, f"{tmp_out}/models", f"{tmp_out}/_models")
    body = '{"pickup_datetime":"2013-07-02 19:54:00 UTC","pickup_longitude":-73.98,"pickup_latitude":40.75,"dropoff_longitude":-73.95,"dropoff_latitude":40.78,"passenger_count":1}'
    asked = spark.createDataFrame([(1, "v1", body), (2, "v2", body)], "request_id long, model_version string, value string")
    score = lifecycle.scoring_batch(shelf, f"{tmp_out}/scored")

    def status(mb):
        return {r.request_id: (r.status, r.known) for r in spark.read.parquet(f"{tmp_out}/scored/mb={mb}").collect()}
    score(asked, 0)
    assert status(0) == {1: ("ok", ["v1"]), 2: ("unknown_model", ["v1"])}
    _publish(spark, tmp_out, 2, 3.0)
    score(asked, 0)  # the retry
    assert status(0)[2] == ("unknown_model", ["v1"])
    score(asked, 1)
    assert status(1) == {1: ("ok", ["v1", "v2"]), 2: ("ok", ["v1", "v2"])}
    shelf.close()
    again = lifecycle.ModelShelf(spark, f"{tmp_out}/models", f"{tmp_out}/_models")  # another driver
    assert set(again.as_of(0)) == {"fare_model_v1"} and set(again.as_of(1)) == {"fare_model_v1", "fare_model_v2"}
    assert again.models(1).filter(F.col("model_version") == "v2").count() == 1
    again.close()


def test_a_micro_batch_of_requests_is_dealt_out(spark, tmp_out, monkeypatch):
    """Requests that came in one file are scored by several tasks."""
    from tripspark.operators import requests

    models = spark.createDataFrame([("v1",)], "model_version string")
    shelf = type("Shelf", (), {"models": lambda self, batch_id: models})()
    monkeypatch.setattr(requests, "score", lambda df, models: df.withColumn("task", F.spark_partition_id()))
    monkeypatch.setattr(requests, "with_status", lambda df, versions: df)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        batch = spark.range(400).select(F.col("id").alias("request_id"), F.lit("v1").alias("model_version"), F.lit("{}").alias("value")).coalesce(1)
        lifecycle.scoring_batch(shelf, tmp_out)(batch, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    out = spark.read.parquet(f"{tmp_out}/mb=0")
    assert out.count() == 400 and out.select("task").distinct().count() > 1
