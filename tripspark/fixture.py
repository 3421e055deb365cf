"""Synthetic raw trips derived from the ``events`` table.

The original ships no data, so the raw CSV trips are derived from ``events`` by
integer arithmetic (coordinates in micro-degrees, fares in cents) such that
Spark and DuckDB produce the same text cells. Every fault class of the input
(blank fields, unparsable fields, out-of-range values, zero-length and
degenerate trips, bad passenger counts) occurs at a fixed ``event_id`` modulus.
The row count grows with ``events``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import REQUEST_SCHEMA

# Fault moduli of the fixture, keyed by what they break.
FAULTS = {
    "null_key": 11,
    "blank_fare": 97,
    "text_fare": 101,
    "negative_fare": 53,
    "huge_fare": 47,
    "garbage_datetime": 79,
    "blank_pickup_longitude": 83,
    "fractional_passengers": 89,
    "dropoff_at_origin_0_0": 61,
    "dropoff_equals_pickup": 59,
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fixed(micro, decimals: int = 6):
    """Non-negative integer ``micro`` / 10**decimals rendered as ``I.FFFFFF``."""
    scale = 10 ** decimals
    whole = F.floor(micro / float(scale)).cast("bigint").cast("string")
    frac = F.lpad((micro % scale).cast("string"), decimals, "0")
    return F.concat(whole, F.lit("."), frac)


def raw_trips(events: DataFrame, with_key: bool = True) -> DataFrame:
    """Raw CSV-like trips: ``row_no`` plus eight text cells (FIXTURES.md)."""
    e = F.col("event_id")
    plon = F.lit(73850000) + (e * 37) % 200000
    plat = F.lit(40600000) + (e * 53) % 250000
    dlon0 = F.lit(73850000) + (e * 71) % 200000
    dlat0 = F.lit(40600000) + (e * 91) % 250000
    m = events.select(
        e.alias("row_no"), "ts", "user_id", "value",
        plon.alias("plon"), plat.alias("plat"), dlon0.alias("dlon0"), dlat0.alias("dlat0"))
    at_origin = F.col("row_no") % FAULTS["dropoff_at_origin_0_0"] == 0
    same = F.col("row_no") % FAULTS["dropoff_equals_pickup"] == 0
    m = m.withColumns({
        "dlon": F.when(at_origin, 0).when(same, F.col("plon")).otherwise(F.col("dlon0")),
        "dlat": F.when(at_origin, 0).when(same, F.col("plat")).otherwise(F.col("dlat0")),
        "cents": (F.lit(250)
                  + F.floor((F.abs(F.col("dlon0") - F.col("plon")) + F.abs(F.col("dlat0") - F.col("plat"))) / 200.0)
                  .cast("bigint")
                  + F.round(F.col("value") * 10).cast("bigint")),
    })
    r = F.col("row_no")
    fare_text = F.concat(F.floor(F.col("cents") / 100.0).cast("bigint").cast("string"), F.lit("."),
                         F.lpad((F.col("cents") % 100).cast("string"), 2, "0"))
    cols = [r.alias("row_no")]
    if with_key:
        cols.append(F.when(r % FAULTS["null_key"] == 0, F.lit(None).cast("string"))
                    .otherwise(F.concat(F.lit("k"), r.cast("string"))).alias("key"))
    cols += [
        F.when(r % FAULTS["blank_fare"] == 0, F.lit(""))
         .when(r % FAULTS["text_fare"] == 0, F.lit("n/a"))
         .when(r % FAULTS["negative_fare"] == 0, F.lit("-2.50"))
         .when(r % FAULTS["huge_fare"] == 0, F.lit("600.00"))
         .otherwise(fare_text).alias("fare_amount"),
        F.when(r % FAULTS["garbage_datetime"] == 0, F.lit("garbage"))
         .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))).alias("pickup_datetime"),
        F.when(r % FAULTS["blank_pickup_longitude"] == 0, F.lit(""))
         .otherwise(F.concat(F.lit("-"), _fixed(F.col("plon")))).alias("pickup_longitude"),
        _fixed(F.col("plat")).alias("pickup_latitude"),
        F.concat(F.when(F.col("dlon") == 0, F.lit("")).otherwise(F.lit("-")), _fixed(F.col("dlon")))
         .alias("dropoff_longitude"),
        _fixed(F.col("dlat")).alias("dropoff_latitude"),
        F.when(r % FAULTS["fractional_passengers"] == 0, F.lit("1.5"))
         .otherwise((F.col("user_id") % 9).cast("string")).alias("passenger_count"),
    ]
    return m.select(*cols)


#: Part of every cache key of materialized tables. Raise it when the code that makes them changes.
TABLES_VERSION = 2


def table_tag(*parts: object) -> str:
    """Name of a materialized table made from ``parts``."""
    return hashlib.sha1("|".join(map(str, (TABLES_VERSION, *parts))).encode()).hexdigest()[:16]


def raw_source_path(spark: SparkSession, sf_dir: str) -> str:
    """Materialize the raw trips once per input as a header CSV and return its path.

    The original reads its trips from a CSV file; the derived trips are written
    the same way into the shared scratch folder (``spark.checkpoint.dir``) and
    every query scans that file. Keyed by the ``events`` file identity.
    """
    from .session import file_signature, materialize, shared_dir
    from .sources.files import write_raw_csv

    events = f"{sf_dir.rstrip('/')}/events.parquet"
    tag = table_tag(sf_dir.rstrip("/"), file_signature(spark, events))
    path = f"{shared_dir(spark)}/tripspark/raw_trips/{tag}"

    return materialize(spark, path, lambda p: write_raw_csv(_in_order(spark, sf_dir), p))


def _in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips range-split by position into at least one file per core: files follow the arrival
    order, and scans of the source get full parallelism. Events are split and sorted, so the texts are made once, not also for the sample of
    positions, and a task sorts the four columns they are made from, not the texts."""
    from .session import default_parallelism

    events = read_table(spark, sf_dir, "events").repartitionByRange(default_parallelism(spark), "event_id")
    return raw_trips(events.sortWithinPartitions("event_id"))


def write_plain_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The same source as the original's file has it: no position column."""
    _in_order(spark, sf_dir).drop("row_no").write.mode("overwrite").option("header", True).csv(path)


def load_raw_trips(spark: SparkSession, sf_dir: str, with_key: bool = True) -> DataFrame:
    """Raw trips as text cells, scanned from the materialized CSV source."""
    from .sources.files import read_raw_csv

    df = read_raw_csv(spark, raw_source_path(spark, sf_dir))
    return df if with_key else df.drop("key")


def requests_from_trips(trips: DataFrame) -> DataFrame:
    """Scoring requests built from valid trips (FIXTURES.md ``requests``).

    ``request_id`` = ``row_no``; every tenth asks for a model that does not
    exist; some bodies are NULL, ``{}`` or not JSON at all.
    """
    r = F.col("row_no")
    body = F.to_json(F.struct(*[F.col(f.name) for f in REQUEST_SCHEMA.fields]))
    return trips.select(
        r.alias("request_id"),
        F.when(r % 10 == 9, F.lit("v9")).otherwise(F.concat(F.lit("v"), (r % 3 + 1).cast("string")))
         .alias("model_version"),
        F.when(r % 17 == 0, F.lit(None).cast("string"))
         .when(r % 19 == 0, F.lit("{}"))
         .when(r % 23 == 0, F.lit("not json"))
         .otherwise(body).alias("value"),
    )
