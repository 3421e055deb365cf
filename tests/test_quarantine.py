"""Broken batch files: states and reasons, versions trained without them."""
import pytest
from pyspark.sql import functions as F

from tripspark.operators import training
from tripspark.session import copy_head, list_dir
from tripspark.sources import files, quarantine

HEAD = "key,fare_amount,pickup_datetime,pickup_longitude,pickup_latitude,dropoff_longitude,dropoff_latitude,passenger_count\n"
ROW = "k,5.0,2013-07-02 19:54:00 UTC,-73.98,40.75,-73.95,40.78,1\n"


def _text(spark, path, name, body):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(body.encode()))
    out.close()


def test_states(spark, tmp_out):
    _text(spark, tmp_out, "batch_1.csv", HEAD + ROW * 3)
    _text(spark, tmp_out, "batch_2.csv", HEAD + ROW * 2)
    _text(spark, tmp_out, "batch_3.csv", HEAD)
    _text(spark, tmp_out, "batch_4.csv", HEAD + ROW * 2 + "k,5.0\n")
    _text(spark, tmp_out, "batch_5.csv.gz", "this is no gzip file " * 40)
    _text(spark, tmp_out, "batch_6_final.csv", HEAD + ROW)
    _text(spark, tmp_out, "notes.csv", "a\n1\n")
    got = {r.batch_no: (r.n_rows, r.reason) for r in quarantine.file_states(spark, tmp_out, 3).collect()}
    assert got[1] == (3, None) and got[2] == (2, "truncated") and got[3] == (0, "empty") and got[6] == (1, None)
    assert got[4] == (3, "bad_record") and got[5] == (0, "unreadable") and len(got) == 6
    states = quarantine.file_states(spark, tmp_out, 3)
    lost = quarantine.quarantined(states)
    assert {r.batch_no: r.reasons for r in lost.collect()} == {2: "truncated", 3: "empty", 4: "bad_record", 5: "unreadable"}
    kept = quarantine.sound_rows(quarantine.read_leniently(spark, tmp_out), lost)
    assert sorted(r.batch_no for r in kept.collect()) == [1, 1, 1, 6]
    expected = spark.createDataFrame([(6, 2)], "batch_no int, n_expected long")
    assert {r.batch_no: r.reason for r in quarantine.file_states(spark, tmp_out, 3, rows_of=expected).collect()}[6] == "truncated"
    assert sorted(r.pos_numeric for r in quarantine.catalog(states).collect()) == [1, 2, 3, 4, 5, 6]


def test_file_cut_in_the_middle(spark, tmp_out):
    rows = spark.range(4000).select(F.concat(F.lit("k"), F.sha2(F.col("id").cast("string"), 256)).alias("key"), *[F.rand(i).cast("string").alias(f"c{i}") for i in range(7)])
    rows.coalesce(1).write.option("header", True).option("compression", "gzip").csv(f"{tmp_out}/whole")
    name = next(n for n, _ in list_dir(spark, f"{tmp_out}/whole") if n.startswith("part-"))
    size = spark.read.format("binaryFile").load(f"{tmp_out}/whole/{name}").select("length").first()[0]
    copy_head(spark, f"{tmp_out}/whole/{name}", f"{tmp_out}/cut/batch_1.csv.gz", size // 2)
    state = quarantine.file_states(spark, f"{tmp_out}/cut", 4000).first()
    assert state.reason == "truncated" and state.n_rows < 4000


def test_a_file_that_breaks_the_shared_read(spark, tmp_out):
    """Without a quarantine the read of all batches fails; versions that don't hold the broken batch are still trained."""
    def trips(n, seed):
        return [("k", float(5 + i % 7), -73.9 - i % 3 / 100, 40.7, -73.95, 40.75 + i % 5 / 100, 1 + i % 4, i % 24, 1 + i % 7, 1 + i % 12, float(1 + i % 9)) for i in range(seed, seed + n)]
    cols = "key string, fare_amount double, pickup_longitude double, pickup_latitude double, dropoff_longitude double, dropoff_latitude double, passenger_count int, hour int, day_of_week int, month int, distance_km double"
    for b in (1, 2, 3):
        spark.createDataFrame(trips(60, b), cols).coalesce(1).write.parquet(f"{tmp_out}/data/batch_no={b}")
    name = next(n for n, _ in list_dir(spark, f"{tmp_out}/data/batch_no=3") if n.startswith("part-"))
    copy_head(spark, f"{tmp_out}/data/batch_no=3/{name}", f"{tmp_out}/data/batch_no=3/{name}.cut.parquet", 200)
    data = spark.read.schema(cols + ", batch_no int").parquet(f"{tmp_out}/data")
    vb = spark.createDataFrame([(v, b) for v in (1, 2, 3) for b in range(1, v + 1)], "version int, batch_no int")
    got = training.train_versions(spark, data, vb, f"{tmp_out}/models", kind="lr")
    assert [(r.version, r.status, r.n_rows) for r in got][:2] == [(1, "saved", 60), (2, "saved", 120)] and got[2].status == "failed" and got[2].error
