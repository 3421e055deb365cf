"""Distance and calendar features."""

import math

import numpy as np
import pytest

from tripspark import fixture
from tripspark.functions import geo, timefeat
from tripspark.operators import features, quality
from tripspark.schemas import FEATURE_COLUMNS


def test_time_features_utc_whatever_session_zone(spark):
    df = spark.createDataFrame([("2013-07-02 19:54:00 UTC",), ("garbage",), (None,)], "pickup_datetime STRING")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ["UTC", "Asia/Jakarta", "America/New_York"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            rows = timefeat.with_time_features(df).collect()
            assert (rows[0].hour, rows[0].day_of_week, rows[0].month) == (19, 3, 7), tz
            assert rows[1].hour is None and rows[2].month is None
            txt = df.select(timefeat.utc_text(timefeat.parse_pickup("pickup_datetime")).alias("t")).first().t
            assert txt == "2013-07-02 19:54:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _dist(spark, pts, max_km=geo.DEFAULT_MAX_KM):
    df = spark.createDataFrame(pts, "lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE")
    return [r.d for r in df.select(geo.haversine_km("lon1", "lat1", "lon2", "lat2", max_km).alias("d")).collect()]


def test_haversine_basics(spark):
    d = _dist(spark, [(-73.98, 40.75, -73.98, 40.75), (-73.98, 40.75, -73.95, 40.78),
                      (-73.95, 40.78, -73.98, 40.75), (None, 40.0, -73.0, 40.0)])
    assert d[0] == 0.0
    assert d[1] == pytest.approx(d[2], abs=1e-12) and 4.0 < d[1] < 4.5
    assert d[3] is None


def test_haversine_cap_edge(spark):
    # 1 degree of latitude ≈ 111.19 km; 1.8° ≈ 200.15 km
    lat = 200.0 / (math.pi * geo.EARTH_RADIUS_KM / 180.0)
    d = _dist(spark, [(0.0, 0.0, 0.0, lat - 1e-6), (0.0, 0.0, 0.0, lat + 1e-6), (-73.0, 40.0, 0.0, 0.0)])
    assert d[0] is not None and d[0] < 200
    assert d[1] is None and d[2] is None
    un = _dist(spark, [(-73.0, 40.0, 0.0, 0.0)], max_km=None)
    assert un[0] > 8000


def test_haversine_nan_and_antipodes(spark):
    capped = _dist(spark, [(float("nan"), 40.0, -73.0, 40.0)])
    assert capped[0] is None
    un = _dist(spark, [(float("nan"), 40.0, -73.0, 40.0), (0.0, 0.0, 180.0, 0.0)], max_km=None)
    assert math.isnan(un[0])
    assert un[1] == pytest.approx(math.pi * geo.EARTH_RADIUS_KM)


def test_native_equals_udf_and_sql(spark):
    rng = np.random.default_rng(7)
    pts = [tuple(float(x) for x in row) for row in
           np.column_stack([rng.uniform(-75, -73, 300), rng.uniform(40, 42, 300),
                            rng.uniform(-75, -73, 300), rng.uniform(40, 42, 300)])]
    pts.append((None, 40.0, -73.0, 40.0))
    df = spark.createDataFrame(pts, "lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE")
    name = geo.register_sql_function(spark, "hav_test")
    df.createOrReplaceTempView("hav_pts")
    udf = geo.haversine_pandas_udf()
    out = spark.sql(f"SELECT *, {name}(lon1, lat1, lon2, lat2) AS s FROM hav_pts").select(
        geo.haversine_km("lon1", "lat1", "lon2", "lat2").alias("n"),
        udf("lon1", "lat1", "lon2", "lat2").alias("u"), "s").collect()
    for r in out:
        if r.n is None:
            assert r.u is None and r.s is None
        else:
            assert r.u == pytest.approx(r.n, rel=1e-12) and r.s == pytest.approx(r.n, rel=1e-12)


def test_training_rows_compute_time_and_distance_once(spark):
    """Rules on the time and the distance do not compute them again; the rows are those of the cleaned features."""
    ok = ("2013-07-02 19:54:00 UTC", -73.98, 40.75, -73.95, 40.78, 1, 10.0)
    odd = [ok, ("garbage", *ok[1:]), (None, *ok[1:]), (ok[0], None, *ok[2:]), (ok[0], -73.98, 40.75, -73.98, 40.75, 1, 10.0), (*ok[:5], None, 10.0),
           (*ok[:6], float("nan")), (ok[0], float("nan"), *ok[2:]), (*ok[:5], 7, 10.0), (*ok[:6], 500.0), (ok[0], -74.9, 40.1, -73.1, 41.9, 2, 60.0)]
    trips = spark.createDataFrame([(i, *r) for i, r in enumerate(odd)], "row_no long, pickup_datetime string, pickup_longitude double, pickup_latitude double, "
                                  "dropoff_longitude double, dropoff_latitude double, passenger_count int, fare_amount double")
    got = features.training_rows(trips, keep=["row_no"])
    want = quality.clean(features.add_features(trips)).select("row_no", "fare_amount", *FEATURE_COLUMNS).na.drop(subset=FEATURE_COLUMNS)
    assert got.schema.simpleString() == want.schema.simpleString() and sorted(got.collect()) == sorted(want.collect()) and {r.row_no for r in got.collect()} == {0}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not any("ASIN" in line for line in plan.splitlines() if "Filter" in line) and plan.count("cast(pickup_datetime") == 1


def test_raw_texts_are_made_after_events_are_split(spark, tmp_out):
    """The sample that splits events by position does not make their texts; rows are the same and in order."""
    events = spark.range(500).selectExpr("499 - id AS event_id", "timestamp_seconds(id) AS ts", "id % 5 AS user_id", "id / 7D AS value")
    events.write.parquet(f"{tmp_out}/events.parquet")
    rows = fixture._in_order(spark, tmp_out)
    got = rows.collect()
    assert [r.row_no for r in got] == list(range(500)) and got == fixture.raw_trips(events).orderBy("row_no").collect()
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("garbage") < plan.index("RepartitionByExpression")


def test_source_sorts_events_not_texts(spark, tmp_out):
    """The raw source's rows are ordered before their texts are made: a task sorts the columns of ``events`` that they are made from."""
    spark.range(50).selectExpr("49 - id AS event_id", "timestamp'2020-01-01' AS ts", "id AS user_id", "1.0D AS value", "repeat('x', 99) AS props").write.parquet(f"{tmp_out}/events.parquet")
    rows = fixture._in_order(spark, tmp_out)
    node = rows._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Sort":
        node = node.children().head()
    assert {a.split("#")[0] for a in node.output().mkString(" ").split()} == {"event_id", "ts", "user_id", "value"}
    assert [r.row_no for r in rows.collect()] == list(range(50))
