"""Great-circle distance.

One native expression serves training and scoring; the Python-side twins exist
only to prove equality and to offer the SQL-callable form.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Mean Earth radius in km and the default "not a taxi trip" cap.
EARTH_RADIUS_KM = 6371.0
DEFAULT_MAX_KM = 200.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lon1, lat1, lon2, lat2, max_km: float | None = DEFAULT_MAX_KM) -> Column:
    """Haversine distance in km, ``2R·asin(√a)``; NULL if any input is NULL.

    ``max_km`` caps implausible trips: a distance not below it (or NaN) becomes
    NULL. ``max_km=None`` is the uncapped variant. ``a`` is clamped to 1 so
    rounding near antipodal points cannot leave the domain of ``asin``.

    Every intermediate is referenced once: filters on the distance are pushed
    below the projection that computes it and inlined, so each extra reference
    would be evaluated again per row.
    """
    la1, la2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = la2 - la1
    dlon = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin(dlon / 2), 2)
    if max_km is None:
        # NaN compares greater than 1 in Spark, so test it explicitly to keep it NaN.
        a = F.when(F.isnan(a) | (a <= 1.0), a).otherwise(F.lit(1.0))
        return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))
    # Capped: a NaN `a` clamps to 1 (half the circumference, above any cap), so
    # it still ends up NULL, like every distance not below the cap.
    d = F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))
    return F.when(d < max_km, d)


def with_distance(df, max_km: float | None = DEFAULT_MAX_KM, out: str = "distance_km"):
    return df.withColumn(out, haversine_km("pickup_longitude", "pickup_latitude",
                                           "dropoff_longitude", "dropoff_latitude", max_km))


def _haversine_np(lon1, lat1, lon2, lat2, max_km):
    la1, la2 = np.radians(lat1), np.radians(lat2)
    dlat = la2 - la1
    dlon = np.radians(lon2) - np.radians(lon1)
    a = np.sin(dlat / 2) ** 2 + np.cos(la1) * np.cos(la2) * np.sin(dlon / 2) ** 2
    a = np.where(a > 1.0, 1.0, a)
    d = 2 * EARTH_RADIUS_KM * np.arcsin(np.sqrt(a))
    if max_km is not None:
        d = np.where(d < max_km, d, np.nan)
    return d


def haversine_pandas_udf(max_km: float | None = DEFAULT_MAX_KM):
    """Arrow-batched twin of :func:`haversine_km` (D1), for equality checks."""

    @F.pandas_udf(DoubleType())
    def _hav(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
        vals = [s.astype("float64") for s in (lon1, lat1, lon2, lat2)]
        null = lon1.isna() | lat1.isna() | lon2.isna() | lat2.isna()
        with np.errstate(invalid="ignore"):
            d = pd.Series(_haversine_np(*vals, max_km), index=lon1.index)
        # NULL in, or capped / NaN out → NULL (pandas NA maps to SQL NULL).
        return d.where(~null & d.notna(), None)

    return _hav


def register_sql_function(spark: SparkSession, name: str = "haversine_km",
                          max_km: float | None = DEFAULT_MAX_KM) -> str:
    """Register a SQL-bodied temporary function (D2); Catalyst inlines it."""
    a = ("pow(sin((radians(lat2) - radians(lat1)) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2))"
         " * pow(sin((radians(lon2) - radians(lon1)) / 2), 2)")
    if max_km is None:
        ac = f"CASE WHEN isnan({a}) OR ({a}) <= 1.0 THEN {a} ELSE 1.0 END"
        body = f"{2 * EARTH_RADIUS_KM} * asin(sqrt({ac}))"
    else:
        d = f"{2 * EARTH_RADIUS_KM} * asin(sqrt(least({a}, 1.0)))"
        body = f"CASE WHEN {d} < {float(max_km)} THEN {d} END"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}"
              f"(lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE) RETURNS DOUBLE RETURN {body}")
    return name
