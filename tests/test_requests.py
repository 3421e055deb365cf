"""Request bodies as VARIANT: statuses, types, whole echo, one parse."""
import json

import pytest

from tripspark.operators import requests as bodies
from tripspark.operators import gram, scoring
from tripspark.schemas import BASIC_FEATURE_COLUMNS

FULL = {"pickup_datetime": "2013-07-02 19:54:00 UTC", "pickup_longitude": -73.98, "pickup_latitude": 40.75, "dropoff_longitude": -73.95, "dropoff_latitude": 40.78, "passenger_count": 1}
CASES = [
    (None, "no_input"), ("", "no_input"), ("  ", "no_input"), ("{}", "no_input"), (" { } ", "no_input"), ("[]", "no_input"), ("null", "no_input"), ("0", "no_input"),
    ("false", "no_input"), ('""', "no_input"), ("not json", "bad_input"), ("[1]", "bad_input"), ('"text"', "bad_input"), ("7", "bad_input"), ("true", "bad_input"),
    (json.dumps(FULL), "accepted"), (json.dumps({**FULL, "passenger_count": None}), "accepted"), ('{"other": 1}', "accepted"),
    (json.dumps({**FULL, "passenger_count": "1"}), "bad_input"), (json.dumps({**FULL, "passenger_count": 1.5}), "bad_input"),
    (json.dumps({**FULL, "passenger_count": 10**12}), "bad_input"), (json.dumps({**FULL, "pickup_longitude": -74}), "accepted"),
    (json.dumps({**FULL, "pickup_longitude": "x"}), "bad_input"), (json.dumps({**FULL, "pickup_datetime": 5}), "bad_input"), (json.dumps({**FULL, "pickup_latitude": [1]}), "bad_input"),
]


def test_statuses(spark):
    rows = spark.createDataFrame([(i, "v1", v) for i, (v, _) in enumerate(CASES)] + [(99, "v2", None), (100, None, "{}")], "request_id long, model_version string, value string")
    got = {r.request_id: r for r in bodies.with_status(bodies.parsed(rows), ["v1"]).drop("body").collect()}
    assert [(CASES[i][0], got[i].status) for i in range(len(CASES))] == list(CASES)
    assert got[99].status == got[100].status == scoring.UNKNOWN_MODEL
    full = got[[c[0] for c in CASES].index(json.dumps(FULL))]
    assert all(full[k] == v for k, v in FULL.items())


def test_one_parse(spark):
    rows = spark.createDataFrame([(1, "v1", "{}")], "request_id long, model_version string, value string")
    plan = bodies.with_status(bodies.parsed(rows), ["v1"]).drop("body")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") + plan.lower().count("parse_json") == 1


@pytest.fixture(scope="module")
def models(spark):
    m = spark.createDataFrame([(1, 10, [0.0, 0.0, 0.0, 0.0, 2.0], 3.5)], "batch_no int, n bigint, coefficients array<double>, intercept double")
    return gram.packed(m, BASIC_FEATURE_COLUMNS)


def test_records_echo_everything(spark, models):
    said = [json.dumps({**FULL, "tip": 1.5, "note": {"path": [1, None, "é"]}}), json.dumps({k: v for k, v in FULL.items() if k != "passenger_count"}), "{}", "nope"]
    rows = spark.createDataFrame([(i, "v1", v) for i, v in enumerate(said)] + [(9, "v5", said[0])], "request_id long, model_version string, value string")
    out = bodies.score(bodies.with_status(bodies.parsed(rows), ["v1"]), models)
    got = {r.request_id: (r.status, json.loads(r.record)) for r in bodies.records(out).collect()}
    assert got[0] == ("ok", {"model_version": "fare_model_v1", "input_data": json.loads(said[0]), "predicted_fare": 5.5})
    assert got[1] == ("no_prediction", {"model_version": "fare_model_v1", "input_data": json.loads(said[1]), "warning": scoring.NO_PREDICTION_WARNING})
    assert got[2] == ("no_input", {"error": "No input data provided"}) and got[3][0] == "bad_input"
    assert got[9] == ("unknown_model", {"error": "Model fare_model_v5 not loaded or does not exist"})
    assert bodies.score(bodies.with_status(bodies.parsed(rows.filter("false")), ["v1"]), models).count() == 0


def test_members_are_read_once(spark):
    """A member's type and value are each asked for in one place, however many columns depend on them."""
    rows = spark.createDataFrame([(1, "v1", json.dumps(FULL))], "request_id long, model_version string, value string")
    df = bodies.with_status(bodies.parsed(rows), ["v1"]).drop("body")
    plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
    n = len(scoring.REQUEST_FIELDS)
    assert plan.count("try_variant_get") <= n + 2 and plan.count("schemaofvariant(") + plan.count("schema_of_variant(") <= n + 1


def test_null_members_and_nested_bodies(spark):
    said = ['{"passenger_count": null}', '{"note": {"passenger_count": "x"}}', "[[1]]", "[{}]", '{"passenger_count": {}}', '{"Passenger_count": "x"}', '"0"', "0.0", "[null]"]
    rows = spark.createDataFrame([(i, "v1", v) for i, v in enumerate(said)], "request_id long, model_version string, value string")
    got = {r.request_id: r.status for r in bodies.with_status(bodies.parsed(rows), ["v1"]).drop("body").collect()}
    assert [got[i] for i in range(len(said))] == ["accepted", "accepted", "bad_input", "bad_input", "bad_input", "accepted", "no_input", "no_input", "no_input"]


def test_bodies_of_other_versions_are_not_read(spark):
    """A request for a model that isn't there is answered before its input is read; every other one as if all were read."""
    rows = spark.createDataFrame([(i, m, v) for i, (v, _) in enumerate(CASES) for m in ("v1", "v2", "v9", None)], "request_id long, model_version string, value string")
    for versions in (["v1"], ["v1", "v2"], []):
        some = bodies.parsed(rows, versions=versions)
        assert some.filter("body is not null").select("model_version").distinct().count() == len(versions)
        want, got = (bodies.with_status(d, versions) for d in (bodies.parsed(rows), some))
        known = [c for c in want.columns if c != "body"]
        asked = f"status <> '{scoring.UNKNOWN_MODEL}'"
        assert sorted(map(str, got.select("request_id", "model_version", "status").collect())) == sorted(map(str, want.select("request_id", "model_version", "status").collect()))
        assert sorted(map(str, got.filter(asked).select(known).collect())) == sorted(map(str, want.filter(asked).select(known).collect()))


def test_only_what_is_needed_goes_through_the_python_step(spark, models):
    """The status is found before rows go to Python, so members and their types don't go with them; rows that aren't accepted ask for no model."""
    rows = spark.createDataFrame([(i, m, v) for i, (v, _) in enumerate(CASES) for m in ("v1", "v9", None)], "request_id long, model_version string, value string")
    status = bodies.with_status(bodies.parsed(rows, versions=["v1"]), ["v1"])
    out = bodies.score(status, models).drop("body")
    node = out._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "ArrowEvalPython":
        node = node.children().head()
    names = {a.split("#")[0] for a in node.children().head().output().mkString(" ").split()}
    assert names <= {"request_id", "model_version", "value", "status", *scoring.REQUEST_FIELDS, *BASIC_FEATURE_COLUMNS} and "status" in names
    found = {(r.request_id, r.model_version): r.status for r in status.collect()}
    got = {(r.request_id, r.model_version): (r.status, r.predicted_fare) for r in out.collect()}
    assert {k: "accepted" if s in (scoring.OK, scoring.NO_PREDICTION) else s for k, (s, _) in got.items()} == found
    assert all((fare is not None) == (s == scoring.OK) for s, fare in got.values())


def test_numbers_are_read_from_their_digits(spark):
    """Numbers of any spelling have the double or whole number that VARIANT's own conversion gives."""
    said = ["0", "-0", "-0.0", "7", "-74", "9007199254740993", "9223372036854775807", "9223372036854775808", "-2147483648", "2147483647", "2147483648", "1.0", "0.1", "1.50",
            "40.7127753", "73.98765432101234567", "0.000001", "0.30000000000000004", "123456789.123456789123456789", "12345678901234567890123456789012345678", "1e2", "1E-7", "1e400",
            "4.35e-5", "0.12345678901234567890123456789012345678", "9" * 40, "-73.999999999999999999"]
    said += [f"{s}{i * 7919 % 180}.{i * 104729 % 10 ** d:0{d}d}" for i in range(60) for d, s in ((2, ""), (6, "-"), (12, ""), (17, "-"))]
    rows = spark.createDataFrame([(i, "v1", f'{{"pickup_longitude": {x}, "passenger_count": {x}}}') for i, x in enumerate(said)], "request_id long, model_version string, value string")
    read = bodies.with_status(bodies.parsed(rows), ["v1"])
    of = "try_variant_get(body, '$.pickup_longitude', 'double')", "CASE WHEN schema_of_variant(try_variant_get(body, '$.passenger_count', 'variant')) = 'BIGINT' THEN try_variant_get(body, '$.passenger_count', 'int') END"
    got = read.selectExpr("request_id", "pickup_longitude", "passenger_count", f"{of[0]} AS x", f"{of[1]} AS n").collect()
    assert len(got) == len(said) and all(repr(r.pickup_longitude) == repr(r.x) and r.passenger_count == r.n for r in got)
    assert all(float(said[r.request_id]) == r.pickup_longitude for r in got) and sum(r.passenger_count is not None for r in got) == 6
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert "passenger_count, $, IntegerType" not in plan
