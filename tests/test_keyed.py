"""Count batching by keyed state: partitions side by side, restart, messages that are no objects."""
import json

import pytest

from tripspark.streaming import keyed

BODY = {"key": "k", "fare_amount": 5.0, "pickup_datetime": "2013-07-02 19:54:00 UTC", "pickup_longitude": -73.98, "pickup_latitude": 40.75,
        "dropoff_longitude": -73.95, "dropoff_latitude": 40.78, "passenger_count": 1}


def _send(spark, path, rows):
    data = [(json.dumps({**BODY, "key": f"{p}-{o}"}) if v is None else v, o, p) for p, o, v in rows]
    spark.createDataFrame(data, "value string, offset long, part int").repartition(3).write.mode("append").parquet(path)


def test_partitions_restart_and_rejects(spark, tmp_out):
    path = f"{tmp_out}/topic"

    def run():
        stream = spark.readStream.schema("value string, offset long, part int").parquet(path)
        keyed.run_keyed_batches(spark, stream, f"{tmp_out}/out", f"{tmp_out}/_chk", 4, partition="part")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    _send(spark, path, [(0, o, None) for o in range(10)] + [(1, o, None) for o in range(3)] + [(1, 99, "[1]"), (2, 0, "nope")])
    run()
    run()  # nothing new, nothing twice
    _send(spark, path, [(0, o, None) for o in range(10, 13)] + [(1, o, None) for o in range(100, 106)])
    run()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    got = sorted((r.partition, r.row_no, r.batch_no, r.key) for r in keyed.read_keyed_batches(spark, f"{tmp_out}/out").collect())
    want = [(0, o, o // 4 + 1, f"0-{o}") for o in range(13)]
    want += [(1, o, i // 4 + 1, f"1-{o}") for i, o in enumerate([*range(3), *range(100, 106)])]
    assert got == want


def test_batch_size_is_checked():
    with pytest.raises(ValueError):
        keyed.NextNumber(0)


def test_the_state_takes_counts(spark, tmp_out):
    """One large partition's rows are not sent through its state: what reaches it are counts, and places are found in several tasks."""
    path = f"{tmp_out}/one"
    _send(spark, path, [(0, o, None) for o in range(50)])
    stream = spark.readStream.schema("value string, offset long, part int").parquet(path)
    plan = keyed.keyed_batches(stream, 7)._jdf.queryExecution().analyzed().toString()
    state = plan[plan.index("TransformWithState"):]
    assert "n#" in state.splitlines()[1] and "MapInArrow" in state
    keyed.run_keyed_batches(spark, stream, f"{tmp_out}/out", f"{tmp_out}/_chk", 7)
    got = sorted((r.row_no, r.batch_no) for r in keyed.read_keyed_batches(spark, f"{tmp_out}/out").collect())
    assert got == [(o, o // 7 + 1) for o in range(50)]
