"""Fixed schemas and column lists of the trip-fare data model."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)

# The members of a trip message, their order and types (batch CSV files follow it).
TRIP_SCHEMA = StructType([
    StructField("key", StringType(), True),
    StructField("fare_amount", DoubleType(), True),
    StructField("pickup_datetime", StringType(), True),
    StructField("pickup_longitude", DoubleType(), True),
    StructField("pickup_latitude", DoubleType(), True),
    StructField("dropoff_longitude", DoubleType(), True),
    StructField("dropoff_latitude", DoubleType(), True),
    StructField("passenger_count", IntegerType(), True),
])

TRIP_COLUMNS = TRIP_SCHEMA.names

# A trip is only forwarded when all of these are present (key is not required).
REQUIRED_FIELDS = [c for c in TRIP_COLUMNS if c != "key"]

COORD_COLUMNS = [c for c in TRIP_COLUMNS if c.endswith(("longitude", "latitude"))]

# Model inputs, in assembler order.
FEATURE_COLUMNS = [
    "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
    "passenger_count", "hour", "day_of_week", "month", "distance_km",
]

# Docs variant: raw coordinates and passengers only.
BASIC_FEATURE_COLUMNS = [
    "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
    "passenger_count",
]

LABEL = "fare_amount"

# Every cell of a raw CSV trip is text.
RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in TRIP_COLUMNS])

REQUEST_SCHEMA = StructType([f for f in TRIP_SCHEMA.fields if f.name not in ("key", "fare_amount")])

# File-backed twin of a Kafka topic: the columns of the Kafka source we use.
TOPIC_SCHEMA = StructType([
    StructField("value", StringType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
])
