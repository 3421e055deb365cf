"""Driver contract and file-source behaviour."""

import pytest
from pyspark.errors import AnalysisException

import __spark_entry__ as ent
from tripspark.sources import files


def test_entry_flagship(spark):
    df = ent.entry(spark)
    assert df.count() == 639
    assert df.columns[:2] == ["row_no", "fare_amount"]


def test_oracles_belong_to_queries():
    q, o = ent.queries(), ent.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60


def test_missing_path_raises(spark):
    with pytest.raises(AnalysisException):
        files.read_raw_csv(spark, "/nonexistent/trips.csv").count()


def test_unreadable_batches_are_skipped(spark, tmp_out):
    spark.createDataFrame([(1,)], "row_no BIGINT").write.option("header", True).csv(f"{tmp_out}/ok")
    df, skipped = files.read_csv_skipping_unreadable(spark, [f"{tmp_out}/ok", f"{tmp_out}/missing"])
    assert skipped == [f"{tmp_out}/missing"] and df is not None


PLAIN = "key,fare_amount,pickup_datetime,pickup_longitude,pickup_latitude,dropoff_longitude,dropoff_latitude,passenger_count"


def test_plain_csv_positions_follow_the_files(spark, tmp_out):
    rows = [(f"k{i:05d}", *["1"] * 7) for i in range(5000)]
    spark.createDataFrame(rows, ", ".join(f"{c} STRING" for c in PLAIN.split(","))).repartitionByRange(4, "key").sortWithinPartitions("key") \
        .write.option("header", True).csv(f"{tmp_out}/plain")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")             # several splits in each file
    try:
        got = files.read_plain_csv(spark, f"{tmp_out}/plain").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.row_no, r.key) for r in got) == [(i, f"k{i:05d}") for i in range(5000)]


def test_plain_csv_with_another_header_fails(spark, tmp_out):
    spark.createDataFrame([(1,) * 8], ", ".join(f"{c} INT" for c in ["row_no", *PLAIN.split(",")[1:]])).write.option("header", True).csv(f"{tmp_out}/other")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_plain_csv(spark, f"{tmp_out}/other").collect()


def test_flat_batch_files_of_the_original(spark, tmp_out):
    import os

    base = tmp_out.replace("file:", "") + "/flat"
    os.makedirs(base)
    line = "k{},5.5,2013-07-02 19:54:00 UTC,-73.98,40.75,-73.95,40.78,1\n"
    for name, n in (("batch_1.csv", 3), ("batch_2.csv", 3), ("batch_10_final.csv", 1), ("notes.csv", 2)):
        with open(f"{base}/{name}", "w") as f:
            f.write(PLAIN + "\n" + "".join(line.format(i) for i in range(n)))
    got = files.read_batch_files(spark, base).groupBy("batch_no").count().collect()
    assert sorted(map(tuple, got)) == [(1, 3), (2, 3), (10, 1)]
    names = files.list_batch_files(spark, base).select("batch_no", "file_name").collect()
    assert sorted(map(tuple, names)) == [(1, "batch_1.csv"), (2, "batch_2.csv"), (10, "batch_10_final.csv")]


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    from tripspark import session

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_first_rows_is_a_position_filter(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(50)], "row_no BIGINT, v STRING")
    got = files.first_rows(df, 7)
    assert sorted(r.row_no for r in got.collect()) == list(range(7))
    assert "row_no" in str(got._jdf.queryExecution().optimizedPlan())
