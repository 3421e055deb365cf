"""Typing and validation of raw cells."""

import math

from pyspark.sql import functions as F

from tripspark.functions import parse
from tripspark.operators import ingest

RAW_COLS = ["row_no", "key", "fare_amount", "pickup_datetime", "pickup_longitude", "pickup_latitude",
            "dropoff_longitude", "dropoff_latitude", "passenger_count"]
GOOD = ["k", "7.5", "2013-07-02 19:54:00 UTC", "-73.98", "40.75", "-73.95", "40.78", "2"]


def _raw(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ", ".join(
        ["row_no BIGINT"] + [f"{c} STRING" for c in RAW_COLS[1:]]))


def test_double_grammar(spark):
    cells = ["1.5", " 1.5", "-2.50", "1e3", ".5", "5.", "inf", "-Infinity", "nan", "-nan", "", None, "n/a", "1d",
             "1_0", "0x10"]
    df = spark.createDataFrame([(c,) for c in cells], "c STRING").select("c", parse.to_double("c").alias("v"))
    got = {r.c: r.v for r in df.collect()}
    assert got["1.5"] == 1.5 and got[" 1.5"] == 1.5 and got["-2.50"] == -2.5 and got["1e3"] == 1000.0
    assert got[".5"] == 0.5 and got["5."] == 5.0
    assert got["inf"] == math.inf and got["-Infinity"] == -math.inf and math.isnan(got["nan"])
    assert math.isnan(got["-nan"])
    for bad in ["", None, "n/a", "1d", "1_0", "0x10"]:
        assert got[bad] is None, bad


def test_int_grammar(spark):
    cells = ["3", " 4 ", "+2", "-1", "1.5", "1.0", "", None, "x", "99999999999"]
    df = spark.createDataFrame([(c,) for c in cells], "c STRING").select("c", parse.to_int("c").alias("v"))
    got = {r.c: r.v for r in df.collect()}
    assert got["3"] == 3 and got[" 4 "] == 4 and got["+2"] == 2 and got["-1"] == -1
    for bad in ["1.5", "1.0", "", None, "x", "99999999999"]:
        assert got[bad] is None, bad


def test_reject_reasons(spark):
    rows = [GOOD,
            [None] + GOOD[1:],                       # no key: still sent
            GOOD[:1] + [""] + GOOD[2:],              # blank fare
            GOOD[:1] + ["n/a"] + GOOD[2:],           # bad fare
            GOOD[:7] + ["1.5"],                      # fractional passengers
            GOOD[:2] + ["garbage"] + GOOD[3:],       # datetime is text: sent
            GOOD[:3] + [None] + GOOD[4:],            # missing longitude
            GOOD[:1] + ["n/a", ""] + GOOD[3:]]       # blank wins over bad
    t = ingest.type_trips(_raw(spark, rows)).orderBy("row_no").collect()
    assert [r.reject_reason for r in t] == [None, None, "missing_field", "bad_value", "bad_value", None,
                                            "missing_field", "missing_field"]
    assert t[1].key == "row_1"
    assert t[0].fare_amount == 7.5 and t[0].passenger_count == 2


def test_key_modes(spark):
    raw = _raw(spark, [GOOD, [None] + GOOD[1:], [""] + GOOD[1:]])
    absent = ingest.type_trips(raw, key_mode="absent").orderBy("row_no").collect()
    assert [r.key for r in absent] == ["k", None, ""]          # only a missing column gets the default
    null = ingest.type_trips(raw, key_mode="null").orderBy("row_no").collect()
    assert [r.key for r in null] == ["k", "row_1", ""]          # empty key is kept, as in the original
    nokey = ingest.type_trips(raw.drop("key"), key_mode="absent").orderBy("row_no").collect()
    assert [r.key for r in nokey] == ["row_0", "row_1", "row_2"]


def test_absent_required_column_rejects_all(spark):
    raw = _raw(spark, [GOOD, GOOD]).drop("passenger_count")
    reasons = {r.reject_reason for r in ingest.type_trips(raw).collect()}
    assert reasons == {"missing_field"}


def test_non_finite_opt_in(spark):
    raw = _raw(spark, [GOOD[:1] + ["nan"] + GOOD[2:], GOOD[:3] + ["inf"] + GOOD[4:]])
    assert {r.reject_reason for r in ingest.type_trips(raw).collect()} == {None}
    assert {r.reject_reason for r in ingest.type_trips(raw, reject_non_finite=True).collect()} == {"non_finite"}


def test_funnel_adds_up(spark):
    raw = _raw(spark, [GOOD, GOOD[:1] + [""] + GOOD[2:], GOOD[:7] + ["x"]])
    f = ingest.ingest_funnel(ingest.type_trips(raw)).first()
    assert (f.raw_rows, f.sent, f.skipped) == (3, 1, 2)
    assert f.skipped_missing_field + f.skipped_bad_value == f.skipped
    assert F is not None


def test_valid_trips_test_each_spelling_once(spark):
    """The trips of ``accepted(type_trips)``, odd cells too, with one test of a cell's spelling instead of two."""
    cells = ["1", "-1.5", "1d", "+nan", "-NaN", "nan", "inf", "-Infinity", " 2 ", "1_0", "", None, "x", "1e3", ".5", "5.", "0x1", "1\u2028", "\u00a01"]
    rows = [(i, None if i % 2 else f"k{i}", c, "2013-07-02 19:54:00 UTC", "-73.9", "40.7", "-73.8", "40.8", "1") for i, c in enumerate(cells)]
    rows += [(100 + i, "k", "5", "2013-07-02 19:54:00 UTC", "-73.9", c, "-73.8", "40.8", p) for i, (c, p) in enumerate((c, p) for c in cells for p in ("1", " 2 ", "1.5", "x", "", None, "99999999999"))]
    rows.append((900, "k", "5", "", "-73.9", "40.7", "-73.8", "40.8", "1"))
    raw = spark.createDataFrame(rows, "row_no long, key string, fare_amount string, pickup_datetime string, pickup_longitude string, pickup_latitude string, "
                                      "dropoff_longitude string, dropoff_latitude string, passenger_count string")
    for frame in (raw, raw.drop("key"), raw.drop("dropoff_latitude")):
        for mode in ("null", "absent"):
            want, got = ingest.accepted(ingest.type_trips(frame, key_mode=mode)), ingest.valid_trips(frame, key_mode=mode)
            assert got.schema == want.schema and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = ingest.valid_trips(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(parse.FLOAT_PATTERN) == len(ingest.DOUBLE_FIELDS) and plan.count(parse.INT_PATTERN) == 1
