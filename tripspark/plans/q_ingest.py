"""Registered queries: typing, validation, features, cleaning (§2.1-2.4, 2.6, 2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codec, geo, parse
from ..functions.timefeat import parse_pickup, utc_text, with_time_features
from ..operators import batching, features, ingest, quality
from ..schemas import BASIC_FEATURE_COLUMNS, FEATURE_COLUMNS, REQUIRED_FIELDS, TRIP_COLUMNS
from ..sources import files
from . import frames
from .oracle_base import with_pipeline
from .registry import query

SENT_COLS = ["row_no", *TRIP_COLUMNS]
FEAT_SQL = ", ".join(c if c != "distance_km" else "round(distance_km, 6) AS distance_km" for c in FEATURE_COLUMNS)


def _round_features(df):
    return df.withColumn("distance_km", F.round("distance_km", 6))


# --- minimum slice: raw → typed → valid → features → cleaning -----------------

@query("feature_table", with_pipeline(f"SELECT row_no, fare_amount, {FEAT_SQL} FROM g"))
def feature_table(spark, sf_dir):
    """Label + nine features of cleaned trips (P13, N1-N6): the flagship query."""
    return _round_features(frames.cleaned(spark, sf_dir))


@query("type_trips", with_pipeline(
    "SELECT row_no, key, fare_amount, pickup_datetime, pickup_longitude, pickup_latitude, "
    "dropoff_longitude, dropoff_latitude, passenger_count, reject_reason FROM typed2"))
def type_trips(spark, sf_dir):
    """Every raw trip typed, with its reject reason."""
    return frames.typed(spark, sf_dir)


@query("valid_trips", with_pipeline(f"SELECT {', '.join(SENT_COLS)} FROM sent"))
def valid_trips(spark, sf_dir):
    return frames.sent(spark, sf_dir)


@query("rejects_by_reason", with_pipeline(
    "SELECT reject_reason, count(*) AS n_rows FROM typed2 WHERE reject_reason IS NOT NULL GROUP BY reject_reason"))
def rejects_by_reason(spark, sf_dir):
    return ingest.rejects_by_reason(frames.typed(spark, sf_dir))


@query("ingest_funnel", with_pipeline(
    "SELECT count(*) AS raw_rows, CAST(count_if(reject_reason IS NULL) AS BIGINT) AS sent, "
    "CAST(count_if(reject_reason IS NOT NULL) AS BIGINT) AS skipped, "
    "CAST(count_if(reject_reason = 'missing_field') AS BIGINT) AS skipped_missing_field, "
    "CAST(count_if(reject_reason = 'bad_value') AS BIGINT) AS skipped_bad_value FROM typed2"))
def ingest_funnel(spark, sf_dir):
    return ingest.ingest_funnel(frames.typed(spark, sf_dir))


@query("blank_to_null", with_pipeline(
    "SELECT row_no, " + ", ".join(f"nullif({c}, '') AS {c}" for c in REQUIRED_FIELDS) + " FROM raw"))
def blank_to_null(spark, sf_dir):
    r = frames.raw(spark, sf_dir)
    return r.select("row_no", *[parse.blank_to_null(c).alias(c) for c in REQUIRED_FIELDS])


@query("key_default_absent", with_pipeline(
    "SELECT row_no, 'row_' || CAST(row_no AS VARCHAR) AS key_when_column_absent, "
    "key AS key_parity FROM raw"))
def key_default_absent(spark, sf_dir):
    """Original rule: default only when the key column is absent (P1, parity mode)."""
    raw = frames.raw(spark, sf_dir)
    return raw.select("row_no", parse.default_key(F.lit(None).cast("string"), "row_no", present=False, mode="absent").alias("key_when_column_absent"),
                      parse.default_key(F.col("key"), "row_no", present=True, mode="absent").alias("key_parity"))


@query("key_default_null", with_pipeline(
    "SELECT row_no, coalesce(key, 'row_' || CAST(row_no AS VARCHAR)) AS key FROM raw"))
def key_default_null(spark, sf_dir):
    return frames.raw(spark, sf_dir).select("row_no", parse.default_key("key", "row_no", mode="null").alias("key"))


_FIRST = "(SELECT count(*) * 35 // 100 FROM events)"


def _first_n(spark, sf_dir) -> int:
    """35 % of the raw rows, as 35,000 of the original's scan: a real cut at every scale."""
    return frames.fixture.read_table(spark, sf_dir, "events").count() * 35 // 100


@query("scan_limit", with_pipeline(
    "SELECT row_no, key, fare_amount, pickup_datetime, passenger_count FROM raw WHERE row_no IN "
    f"(SELECT row_no FROM raw ORDER BY row_no LIMIT {_FIRST})"))
def scan_limit(spark, sf_dir):
    """First-n scan (S2): a position filter on the plain source's row positions."""
    return files.first_rows(frames.raw(spark, sf_dir), _first_n(spark, sf_dir)).select(
        "row_no", "key", "fare_amount", "pickup_datetime", "passenger_count")


@query("sent_limit", with_pipeline(
    f"SELECT row_no, fare_amount FROM sent WHERE row_no IN (SELECT row_no FROM sent ORDER BY row_no LIMIT {_FIRST})"))
def sent_limit(spark, sf_dir):
    """The first n messages sent, counted after validation."""
    sent = batching.dense_index(frames.sent(spark, sf_dir).select("row_no", "fare_amount"), "row_no", out="position")
    return sent.filter(F.col("position") < _first_n(spark, sf_dir)).select("row_no", "fare_amount")


@query("encode_unvalidated", with_pipeline(
    "SELECT row_no, nullif(fare_amount, '') AS fare_amount, nullif(passenger_count, '') AS passenger_count FROM raw"))
def encode_unvalidated(spark, sf_dir):
    """Docs producer: every raw row as a JSON message, unvalidated (K1); checked through two members read back."""
    rows = frames.raw(spark, sf_dir)
    said = rows.select("row_no", codec.encode().alias("value"))
    back = F.from_json("value", "fare_amount STRING, passenger_count STRING")
    return said.select("row_no", back.alias("m")).select("row_no", F.nullif("m.fare_amount", F.lit("")).alias("fare_amount"),
                                                         F.nullif("m.passenger_count", F.lit("")).alias("passenger_count"))


# --- JSON messages -----------------------------------------------------------

@query("json_encode", with_pipeline(
    "SELECT row_no, CAST(8 AS INTEGER) AS n_members, key, fare_amount, pickup_datetime, passenger_count FROM sent"))
def json_encode(spark, sf_dir):
    """Trips → JSON text (K1); checked through the members read back."""
    s = frames.sent(spark, sf_dir).select("row_no", codec.encode().alias("value"))
    j = F.col("value")
    return s.select(
        "row_no",
        F.size(F.json_object_keys(j)).alias("n_members"),
        F.get_json_object(j, "$.key").alias("key"),
        F.get_json_object(j, "$.fare_amount").cast("double").alias("fare_amount"),
        F.get_json_object(j, "$.pickup_datetime").alias("pickup_datetime"),
        F.get_json_object(j, "$.passenger_count").cast("int").alias("passenger_count"))


@query("json_decode", with_pipeline(f"SELECT {', '.join(SENT_COLS)} FROM sent"))
def json_decode(spark, sf_dir):
    """JSON messages → typed trips."""
    msgs = frames.sent(spark, sf_dir).select("row_no", codec.encode().cast("binary").alias("value"))
    return msgs.select("row_no", codec.decode("value").alias("t")).select("row_no", "t.*")


def messages(spark, sf_dir):
    """Topic messages: encoded trips, every 29th replaced by a non-object value."""
    s = frames.sent(spark, sf_dir)
    r = F.col("row_no")
    junk = (F.when((r / 29).cast("bigint") % 4 == 0, F.lit("[1]"))
             .when((r / 29).cast("bigint") % 4 == 1, F.lit('"s"'))
             .when((r / 29).cast("bigint") % 4 == 2, F.lit("garbage")))
    return s.select("row_no", F.when(r % 29 == 0, junk).otherwise(codec.encode()).alias("value"))


# Oracle: every 29th message is replaced by '[1]', '"s"', 'garbage' or NULL in turn.
_MESSAGES_SQL = """
SELECT row_no, CASE WHEN row_no % 29 <> 0 THEN to_json(struct_pack(key, fare_amount))::VARCHAR
  WHEN (row_no // 29) % 4 = 0 THEN '[1]' WHEN (row_no // 29) % 4 = 1 THEN '"s"'
  WHEN (row_no // 29) % 4 = 2 THEN 'garbage' END AS j FROM sent"""


@query("json_objects_only", with_pipeline(
    "SELECT row_no, CASE WHEN j IS NULL THEN false WHEN json_valid(j) THEN json_type(j) = 'OBJECT' "
    f"ELSE false END AS is_object FROM ({_MESSAGES_SQL})"))
def json_objects_only(spark, sf_dir):
    """Non-object messages are flagged, not fatal."""
    return messages(spark, sf_dir).select("row_no", codec.is_object("value").alias("is_object"))


# --- time and distance features ----------------------------------------------

@query("parse_pickup_ts", with_pipeline(
    "SELECT row_no, strftime(pts, '%Y-%m-%d %H:%M:%S') AS pickup_ts FROM b"))
def parse_pickup_ts(spark, sf_dir):
    s = frames.trips(spark, sf_dir)
    return s.select("row_no", utc_text(parse_pickup("pickup_datetime")).alias("pickup_ts"))


@query("time_features", with_pipeline("SELECT row_no, hour, day_of_week, month FROM f"))
def time_features(spark, sf_dir):
    s = frames.trips(spark, sf_dir)
    return with_time_features(s).select("row_no", "hour", "day_of_week", "month")


@query("haversine_capped", with_pipeline("SELECT row_no, round(distance_km, 6) AS distance_km FROM f"))
def haversine_capped(spark, sf_dir):
    s = geo.with_distance(frames.trips(spark, sf_dir))
    return s.select("row_no", F.round("distance_km", 6).alias("distance_km"))


@query("haversine_uncapped", with_pipeline("SELECT row_no, round(d0, 6) AS distance_km FROM d"))
def haversine_uncapped(spark, sf_dir):
    s = features.uncapped_distance(frames.trips(spark, sf_dir))
    return s.select("row_no", F.round("distance_km", 6).alias("distance_km"))


@query("haversine_udf", with_pipeline("SELECT row_no, round(distance_km, 6) AS distance_km FROM f"))
def haversine_udf(spark, sf_dir):
    """Arrow-batched Python twin of the native expression."""
    hav = geo.haversine_pandas_udf()
    s = frames.trips(spark, sf_dir)
    d = hav("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
    return s.select("row_no", F.round(d, 6).alias("distance_km"))


@query("haversine_sql", with_pipeline("SELECT row_no, round(distance_km, 6) AS distance_km FROM f"))
def haversine_sql(spark, sf_dir):
    """SQL-callable distance function (D2), inlined by Catalyst."""
    name = geo.register_sql_function(spark)
    frames.trips(spark, sf_dir).createOrReplaceTempView("tripspark_trips")
    return spark.sql(f"SELECT row_no, round({name}(pickup_longitude, pickup_latitude, dropoff_longitude, "
                     f"dropoff_latitude), 6) AS distance_km FROM tripspark_trips")


@query("round_fare", with_pipeline("SELECT row_no, round(distance_km, 2) AS distance_2dp FROM f"))
def round_fare(spark, sf_dir):
    """Two-decimal rounding as used for fares in responses."""
    f = frames.featured(spark, sf_dir)
    return f.select("row_no", features.round_fare("distance_km").alias("distance_2dp"))


@query("feature_table_basic", with_pipeline(
    "SELECT row_no, fare_amount, " + ", ".join(BASIC_FEATURE_COLUMNS) + " FROM typed2 WHERE fare_amount IS NOT NULL AND "
    + " AND ".join(f"{c} IS NOT NULL" for c in BASIC_FEATURE_COLUMNS)))
def feature_table_basic(spark, sf_dir):
    """Docs variant: unvalidated rows, five raw features, NULL rows dropped."""
    t = frames.typed(spark, sf_dir)
    return features.basic_training_rows(t, keep=["row_no"])


@query("alias_select", with_pipeline("SELECT row_no, batch_no, fare_amount FROM b"))
def alias_select(spark, sf_dir):
    """Frame alias and qualified column references over all batches."""
    b = frames.trips(spark, sf_dir).alias("data_v")
    return b.select("data_v.row_no", "data_v.batch_no", "data_v.fare_amount")


# --- filters and funnel ------------------------------------------------------

def _rule_query(rule_name, where):
    @query(f"filter_{rule_name}", with_pipeline(f"SELECT row_no FROM f WHERE {where}"))
    def _q(spark, sf_dir):
        return quality.drop_rule(frames.featured(spark, sf_dir), rule_name).select("row_no")
    _q.__name__ = f"filter_{rule_name}"
    return _q


filter_fare = _rule_query("fare", "fare_amount > 0 AND fare_amount < 500")
filter_pickup_box = _rule_query("pickup_box", "pickup_longitude BETWEEN -75 AND -73 AND pickup_latitude BETWEEN 40 AND 42")
filter_dropoff_box = _rule_query("dropoff_box",
                                 "dropoff_longitude BETWEEN -75 AND -73 AND dropoff_latitude BETWEEN 40 AND 42")
filter_passengers = _rule_query("passengers", "passenger_count > 0 AND passenger_count < 7")
filter_distance = _rule_query("distance", "distance_km > 0 AND distance_km < 100")
filter_time = _rule_query("time", "hour IS NOT NULL AND day_of_week IS NOT NULL AND month IS NOT NULL")

_FUNNEL_CASE = """CASE WHEN NOT coalesce(fare_amount > 0 AND fare_amount < 500, false) THEN 'fare'
 WHEN NOT coalesce(pickup_longitude BETWEEN -75 AND -73 AND pickup_latitude BETWEEN 40 AND 42, false) THEN 'pickup_box'
 WHEN NOT coalesce(dropoff_longitude BETWEEN -75 AND -73 AND dropoff_latitude BETWEEN 40 AND 42, false) THEN 'dropoff_box'
 WHEN NOT coalesce(passenger_count > 0 AND passenger_count < 7, false) THEN 'passengers'
 WHEN NOT coalesce(distance_km > 0 AND distance_km < 100, false) THEN 'distance'
 WHEN NOT coalesce(hour IS NOT NULL AND day_of_week IS NOT NULL AND month IS NOT NULL, false) THEN 'time' END"""


@query("cleaning_funnel", with_pipeline(
    "SELECT count(*) AS rows_in, "
    + ", ".join(f"CAST(count_if(r = '{n}') AS BIGINT) AS removed_{n}" for n, _ in quality.RULES)
    + ", CAST(count_if(r IS NULL) AS BIGINT) AS rows_kept FROM (SELECT " + _FUNNEL_CASE + " AS r FROM f)"))
def cleaning_funnel(spark, sf_dir):
    return quality.cleaning_funnel(frames.featured(spark, sf_dir))


@query("dropna_all", with_pipeline(
    "SELECT row_no, key FROM typed2 WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in SENT_COLS)))
def dropna_all(spark, sf_dir):
    """Drop rows with a NULL in any column."""
    t = frames.typed(spark, sf_dir).drop("reject_reason")
    return quality.dropna_all(t).select("row_no", "key")
