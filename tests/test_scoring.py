"""Request status and scoring by version."""

import json

import pytest
from pyspark.sql import functions as F

from tripspark.operators import scoring, training
from tripspark.plans import frames

SF = "/root/testdata/sf0.001"
BODY = {"pickup_datetime": "2013-07-02 19:54:00 UTC", "pickup_longitude": -73.98, "pickup_latitude": 40.75,
        "dropoff_longitude": -73.95, "dropoff_latitude": 40.78, "passenger_count": 2}


@pytest.fixture(scope="module")
def models(spark):
    m = training.fit_pipeline(frames.cleaned(spark, SF), kind="lr")
    return {"v1": m, "v2": m}


def _requests(spark, items):
    return spark.createDataFrame([(i, v, b) for i, (v, b) in enumerate(items)],
                                 "request_id BIGINT, model_version STRING, value STRING")


def test_statuses(spark, models):
    reg = spark.createDataFrame([("v1",), ("v2",)], "model_version STRING")
    items = [("v1", json.dumps(BODY)),
             ("v9", None),                                             # unknown wins over missing input
             ("v2", None), ("v2", "  "), ("v2", "{}"), ("v2", "[]"),    # falsy bodies
             ("v1", "not json"), ("v1", "[1]"),                         # not an object
             ("v1", json.dumps({**BODY, "pickup_longitude": "abc"})),   # wrong member type
             ("v1", json.dumps({**BODY, "passenger_count": 2, "pickup_latitude": 40})),  # int in a DOUBLE field
             ("v2", json.dumps({"passenger_count": 1}))]                # missing members are imputed
    st = scoring.request_status(_requests(spark, items), reg)
    got = [r.status for r in st.orderBy("request_id").collect()]
    assert got == ["accepted", "unknown_model", "no_input", "no_input", "no_input", "no_input",
                   "bad_input", "bad_input", "bad_input", "accepted", "accepted"]
    scored = scoring.score(st, models).orderBy("request_id").collect()
    assert [r.status for r in scored] == ["ok", "unknown_model", "no_input", "no_input", "no_input", "no_input",
                                          "bad_input", "bad_input", "bad_input", "ok", "ok"]
    assert all((r.predicted_fare is not None) == (r.status == "ok") for r in scored)
    assert len(scored) == len(items)          # every request keeps exactly one row


def test_prediction_matches_direct_transform(spark, models):
    reg = spark.createDataFrame([("v1",)], "model_version STRING")
    st = scoring.request_status(_requests(spark, [("v1", json.dumps(BODY))]), reg)
    fare = scoring.score(st, models).first().predicted_fare
    from tripspark.operators import features
    direct = models["v1"].transform(features.add_features(st)).first().prediction
    assert fare == pytest.approx(direct, abs=0.005 + 1e-9)


def test_records_of_both_services(spark, models):
    reg = spark.createDataFrame([("v1",), ("v1",)], "model_version STRING")
    st = scoring.request_status(_requests(spark, [("v1", json.dumps(BODY)), ("v3", "{}"), ("v1", "{}"), ("v1", "[1]")]), reg)
    rows = scoring.records(scoring.score(st, {"v1": models["v1"]}), ["v2", "v1"]).orderBy("request_id").collect()
    assert len(rows) == 4                                      # a version listed twice counts once
    ok, unknown, none, bad = [json.loads(r.record) for r in rows]
    assert ok["model_version"] == "fare_model_v1" and ok["input_data"] == BODY and ok["predicted_fare"] > 0
    assert unknown == {"error": "Model fare_model_v3 not loaded or does not exist"}
    assert none == {"error": "No input data provided"} and set(bad) == {"error"}
    ok, unknown, none, bad = [json.loads(r.record_container) for r in rows]
    assert set(ok) == {"model_version_used", "predicted_fare"} and ok["model_version_used"] == "v1"
    assert unknown["available_models"] == ["v1", "v2"] and "'v3' not found" in unknown["error"]


def test_warning_record(spark):
    row = spark.createDataFrame([(1, "v1", json.dumps(BODY), "no_prediction", None)],
                                "request_id BIGINT, model_version STRING, value STRING, status STRING, predicted_fare DOUBLE")
    rec = json.loads(scoring.records(row).first().record)
    assert rec == {"model_version": "fare_model_v1", "input_data": BODY, "warning": scoring.NO_PREDICTION_WARNING}


def test_scoring_reads_each_version_once(spark, models, tmp_out):
    reg = spark.createDataFrame([("v1",), ("v2",)], "model_version STRING")
    _requests(spark, [("v1", json.dumps(BODY)), ("v2", json.dumps(BODY)), ("v7", None), (None, None)]).write.partitionBy("model_version").parquet(f"{tmp_out}/r")
    table = spark.read.schema("request_id BIGINT, value STRING, model_version STRING").parquet(f"{tmp_out}/r").select("request_id", "model_version", "value")
    plan = scoring.score(scoring.request_status(table, reg), models)._jdf.queryExecution().executedPlan().toString()
    scans = [p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:]]
    assert len(scans) == 3 and all("model_version" in s for s in scans)      # disjoint partitions: one read in all


def test_rows_a_model_would_skip_are_kept(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    # a model without imputation: its assembler skips rows with a missing feature
    cols = ["pickup_longitude", "passenger_count"]
    train = frames.cleaned(spark, SF)
    m = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip"),
                         LinearRegression(featuresCol="features", labelCol="fare_amount")]).fit(train)
    reg = spark.createDataFrame([("v1",)], "model_version STRING")
    items = [("v1", json.dumps(BODY)), ("v1", json.dumps({k: v for k, v in BODY.items() if k != "passenger_count"}))]
    out = scoring.score(scoring.request_status(_requests(spark, items), reg), {"v1": m}).orderBy("request_id").collect()
    assert [r.status for r in out] == ["ok", "no_prediction"]
    assert out[1].predicted_fare is None


def test_uncapped_distance_variant(spark, models):
    # a 250 km trip: the capped feature is NULL (imputed), the uncapped one is the real distance
    far = {**BODY, "dropoff_latitude": 43.0}
    reg = spark.createDataFrame([("v1",)], "model_version STRING")
    st = scoring.request_status(_requests(spark, [("v1", json.dumps(far))]), reg)
    capped = scoring.score(st, models).first()
    uncapped = scoring.score(st, models, max_km=None).first()
    assert capped.status == uncapped.status == "ok"
    from tripspark.operators import features
    d = features.add_features(st, max_km=None).first().distance_km
    assert d > 200 and features.add_features(st).first().distance_km is None


def test_null_version_is_unknown_and_kept(spark, models):
    reg = spark.createDataFrame([("v1",)], "model_version STRING")
    req = spark.createDataFrame([(1, None, json.dumps(BODY)), (2, "v1", json.dumps(BODY))],
                                "request_id BIGINT, model_version STRING, value STRING")
    out = scoring.score(scoring.request_status(req, reg), models).orderBy("request_id").collect()
    assert [(r.request_id, r.status) for r in out] == [(1, "unknown_model"), (2, "ok")]
