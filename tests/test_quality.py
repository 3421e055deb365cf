"""Cleaning rule edges (N1-N5, Z6) and the funnel."""

from tripspark.operators import quality

COLS = ("fare_amount DOUBLE, pickup_longitude DOUBLE, pickup_latitude DOUBLE, dropoff_longitude DOUBLE, "
        "dropoff_latitude DOUBLE, passenger_count INT, distance_km DOUBLE, hour INT, day_of_week INT, month INT")
OK = (7.5, -74.0, 41.0, -74.0, 41.0, 2, 3.0, 10, 3, 7)


def _kept(spark, rows):
    df = spark.createDataFrame(rows, COLS)
    return len(quality.clean(df).collect())


def _with(i, v):
    r = list(OK)
    r[i] = v
    return tuple(r)


def test_fare_bounds_exclusive(spark):
    assert _kept(spark, [_with(0, 0.0), _with(0, 500.0), _with(0, float("nan")), _with(0, None)]) == 0
    assert _kept(spark, [_with(0, 0.01), _with(0, 499.99)]) == 2


def test_boxes_inclusive(spark):
    assert _kept(spark, [_with(1, -75.0), _with(1, -73.0), _with(2, 40.0), _with(4, 42.0)]) == 4
    assert _kept(spark, [_with(1, -75.01), _with(3, -72.99), _with(2, float("nan")), _with(4, None)]) == 0


def test_passengers_and_distance(spark):
    assert _kept(spark, [_with(5, 0), _with(5, 7), _with(5, None), _with(6, 0.0), _with(6, 100.0),
                         _with(6, None), _with(7, None)]) == 0
    assert _kept(spark, [_with(5, 1), _with(5, 6), _with(6, 99.99)]) == 3


def test_funnel_first_failure(spark):
    df = spark.createDataFrame([OK, _with(0, 0.0), _with(5, 9), (0.0, -80.0, 41.0, -74.0, 41.0, 9, 3.0, 1, 1, 1)],
                               COLS)
    f = quality.cleaning_funnel(df).first()
    assert (f.rows_in, f.rows_kept, f.removed_fare, f.removed_passengers) == (4, 1, 2, 1)
