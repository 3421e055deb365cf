"""Typing and validation of raw trips.

One narrow projection per row, no shuffle: every rule is a column expression,
so the whole step fuses into the scan's codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parse
from ..schemas import REQUIRED_FIELDS

DOUBLE_FIELDS = ["fare_amount", "pickup_longitude", "pickup_latitude",
                 "dropoff_longitude", "dropoff_latitude"]

ORDER = ["row_no", "key", "fare_amount", "pickup_datetime", "pickup_longitude", "pickup_latitude",
         "dropoff_longitude", "dropoff_latitude", "passenger_count"]

# Reject reasons.
MISSING_FIELD = "missing_field"
BAD_VALUE = "bad_value"
NON_FINITE = "non_finite"


def _raw(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def type_trips(raw: DataFrame, key_mode: str = "null", reject_non_finite: bool = False) -> DataFrame:
    """Raw text trips → typed trips with a ``reject_reason`` (NULL = accepted).

    * ``missing_field``: one of the seven required cells is blank or its column
      is absent.
    * ``bad_value``: all present, but one does not parse.
    * ``non_finite`` (opt-in): a NaN / infinite number; the original forwards
      these and leaves them to the cleaning step.
    """
    typed = _typed(raw, key_mode, parse.to_double, parse.to_int)
    return raw.select(*typed, _reason(raw, typed if reject_non_finite else None).alias("reject_reason"))


def _typed(raw: DataFrame, key_mode: str, to_double, to_int) -> list[Column]:
    if "row_no" not in raw.columns:
        raise ValueError("raw trips need a row_no column (see operators.batching.dense_index)")
    typed = {
        "row_no": F.col("row_no"),
        "key": parse.default_key(_raw(raw, "key"), "row_no", present="key" in raw.columns, mode=key_mode),
    }
    for c in DOUBLE_FIELDS:
        typed[c] = to_double(_raw(raw, c))
    typed["pickup_datetime"] = parse.blank_to_null(_raw(raw, "pickup_datetime"))
    typed["passenger_count"] = to_int(_raw(raw, "passenger_count"))
    return [typed[c].alias(c) for c in ORDER]


def _reason(raw: DataFrame, finite: list[Column] | None = None) -> Column:
    """Why a raw trip is rejected, NULL if it isn't; of ``finite`` (typed columns) the doubles must be finite numbers."""
    missing = F.lit(False)
    for c in REQUIRED_FIELDS:
        missing = missing | parse.is_blank(_raw(raw, c))
    # Validity flags on the raw cells keep the (often pushed-down) filter small.
    bad = ~parse.is_int_text(_raw(raw, "passenger_count"))
    for c in DOUBLE_FIELDS:
        bad = bad | ~parse.is_double_text(_raw(raw, c))
    reason = F.when(missing, F.lit(MISSING_FIELD)).when(bad, F.lit(BAD_VALUE))
    if finite is not None:
        nonfinite = F.lit(False)
        for c in DOUBLE_FIELDS:
            x = finite[ORDER.index(c)]
            nonfinite = nonfinite | F.isnan(x) | (F.abs(x) == float("inf"))
        reason = reason.when(nonfinite, F.lit(NON_FINITE))
    return reason


def accepted(typed: DataFrame) -> DataFrame:
    """Trips that would be sent to the topic (F1 + F2)."""
    return typed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("reject_reason").isNotNull())


def valid_trips(raw: DataFrame, key_mode: str = "null") -> DataFrame:
    """Trips that would be sent, as ``accepted(type_trips(raw))``; each cell's spelling is tested once, by the filter, not again by its conversion."""
    whole = lambda c: c.try_cast("int")
    return raw.filter(_reason(raw).isNull()).select(*_typed(raw, key_mode, parse.spelled_double, whole))


def ingest_funnel(typed: DataFrame) -> DataFrame:
    """Sent / skipped counters in one aggregate (A2): a single row."""
    r = F.col("reject_reason")
    return typed.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(r.isNull()).alias("sent"),
        F.count_if(r.isNotNull()).alias("skipped"),
        F.count_if(r == MISSING_FIELD).alias("skipped_missing_field"),
        F.count_if(r == BAD_VALUE).alias("skipped_bad_value"),
    )


def rejects_by_reason(typed: DataFrame) -> DataFrame:
    """Reject counts per reason; partial aggregation before the (tiny) shuffle."""
    return (rejected(typed).groupBy("reject_reason")
            .agg(F.count(F.lit(1)).alias("n_rows")))
