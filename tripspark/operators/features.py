"""Feature derivation shared by training and scoring.

Training and scoring call the same ``add_features`` so the two cannot drift
apart (the original had three different distance functions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import DEFAULT_MAX_KM, haversine_km, with_distance
from ..functions.timefeat import parse_pickup, with_time_features, with_time_parts
from ..schemas import BASIC_FEATURE_COLUMNS, FEATURE_COLUMNS, LABEL
from . import quality


def add_features(trips: DataFrame, max_km: float | None = DEFAULT_MAX_KM,
                 keep_ts: bool = False) -> DataFrame:
    """Add ``hour, day_of_week, month`` and ``distance_km`` (capped by ``max_km``)."""
    df = with_time_features(trips, "pickup_datetime", ts_col="pickup_ts" if keep_ts else None)
    return with_distance(df, max_km=max_km)


def training_rows(trips: DataFrame, max_km: float | None = DEFAULT_MAX_KM,
                  keep: list[str] | None = None) -> DataFrame:
    """Label + nine features of rows that pass every cleaning rule.

    ``keep`` lists extra columns to carry along (e.g. ``row_no``, ``batch_no``).

    The pickup time and the distance are generated as a row of their own: filters are inlined below a projection, where each
    of the rules would parse the time and compute the distance again, but not below a generator. Rules on the trip columns still reach the scan.
    """
    costly = F.struct(parse_pickup("pickup_datetime").alias("_ts"),
                      haversine_km("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude", max_km).alias("distance_km"))
    f = quality.clean(with_time_parts(trips.drop("distance_km").select("*", F.inline(F.array(costly))), "_ts"))
    return (f.select(*(keep or []), LABEL, *FEATURE_COLUMNS)
             .na.drop(subset=FEATURE_COLUMNS))


def basic_training_rows(trips: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Docs variant: five raw features, rows with any NULL dropped."""
    return trips.select(*(keep or []), LABEL, *BASIC_FEATURE_COLUMNS).na.drop(how="any")


def uncapped_distance(df: DataFrame) -> DataFrame:
    """Scoring-side distance of the root API: no cap."""
    return with_distance(df, max_km=None)


def round_fare(c="prediction", digits: int = 2):
    """Half-up rounding to cents (P17); differs from Python's round on ties."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits)
