"""Cleaning rules for training rows (N1-N8) and their funnel.

Each rule is a named boolean column. ``clean`` ANDs them into one filter that
Catalyst pushes as far down as it can; ``cleaning_funnel`` counts, in one pass,
how many rows each rule removes (first failing rule wins, in rule order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The cleaning limits.
FARE_MIN_EXCLUSIVE = 0
FARE_MAX_EXCLUSIVE = 500
LON_MIN, LON_MAX = -75, -73
LAT_MIN, LAT_MAX = 40, 42
PASSENGERS_MIN_EXCLUSIVE = 0
PASSENGERS_MAX_EXCLUSIVE = 7
DISTANCE_MIN_EXCLUSIVE = 0
DISTANCE_MAX_EXCLUSIVE = 100


def fare_ok() -> Column:
    f = F.col("fare_amount")
    return (f > FARE_MIN_EXCLUSIVE) & (f < FARE_MAX_EXCLUSIVE)


def pickup_box_ok() -> Column:
    return (F.col("pickup_longitude").between(LON_MIN, LON_MAX)
            & F.col("pickup_latitude").between(LAT_MIN, LAT_MAX))


def dropoff_box_ok() -> Column:
    return (F.col("dropoff_longitude").between(LON_MIN, LON_MAX)
            & F.col("dropoff_latitude").between(LAT_MIN, LAT_MAX))


def passengers_ok() -> Column:
    p = F.col("passenger_count")
    return p.isNotNull() & (p > PASSENGERS_MIN_EXCLUSIVE) & (p < PASSENGERS_MAX_EXCLUSIVE)


def distance_ok() -> Column:
    d = F.col("distance_km")
    return d.isNotNull() & (d > DISTANCE_MIN_EXCLUSIVE) & (d < DISTANCE_MAX_EXCLUSIVE)


def time_ok() -> Column:
    return F.col("hour").isNotNull() & F.col("day_of_week").isNotNull() & F.col("month").isNotNull()


# Rule order of the original; the funnel attributes a row to the first rule it fails.
RULES = [
    ("fare", fare_ok),
    ("pickup_box", pickup_box_ok),
    ("dropoff_box", dropoff_box_ok),
    ("passengers", passengers_ok),
    ("distance", distance_ok),
    ("time", time_ok),
]


def _true(c: Column) -> Column:
    # A NULL comparison is "not kept", as in a filter.
    return F.coalesce(c, F.lit(False))


def all_rules() -> Column:
    """Conjunction of every rule; NULL means "not kept" (a filter drops it).

    Kept as plain comparisons so Catalyst can push them into the file scan.
    """
    ok = None
    for _, rule in RULES:
        ok = rule() if ok is None else ok & rule()
    return ok


def clean(features: DataFrame) -> DataFrame:
    """Rows passing every rule."""
    return features.filter(all_rules())


def drop_rule(features: DataFrame, name: str) -> DataFrame:
    """Apply a single rule by name (for per-rule inspection)."""
    return features.filter(dict(RULES)[name]())


def first_failed_rule() -> Column:
    expr = None
    for name, rule in RULES:
        cond = ~_true(rule())
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def cleaning_funnel(features: DataFrame) -> DataFrame:
    """One row: input rows, rows removed by each rule, rows kept."""
    first = first_failed_rule()
    aggs = [F.count(F.lit(1)).alias("rows_in")]
    aggs += [F.count_if(first == F.lit(name)).alias(f"removed_{name}") for name, _ in RULES]
    aggs.append(F.count_if(first.isNull()).alias("rows_kept"))
    return features.agg(*aggs)


def dropna_all(df: DataFrame) -> DataFrame:
    """Docs variant: drop rows with a NULL in any column."""
    return df.na.drop(how="any")
