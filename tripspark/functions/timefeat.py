"""Pickup-time parsing and calendar features.

Calendar parts are computed from the epoch instant, so they are the UTC hour /
weekday / month whatever the session time zone is. (The original read them in
the JVM's default zone, which silently shifts features between machines.)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS_PER_DAY = 86_400_000_000
_MICROS_PER_HOUR = 3_600_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_pickup(c) -> Column:
    """String like ``2013-07-02 19:54:00 UTC`` → TIMESTAMP; NULL if unparsable."""
    return F.try_to_timestamp(_c(c))


def utc_day(ts) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_micros(_c(ts)) / _MICROS_PER_DAY).cast("int"))


def utc_hour(ts) -> Column:
    return F.floor(F.pmod(F.unix_micros(_c(ts)), F.lit(_MICROS_PER_DAY)) / _MICROS_PER_HOUR).cast("int")


def utc_day_of_week(ts) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(utc_day(ts)).cast("int")


def utc_month(ts) -> Column:
    return F.month(utc_day(ts)).cast("int")


def utc_text(ts) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of an instant in UTC, whatever the session zone."""
    ntz = F.convert_timezone(F.current_timezone(), F.lit("UTC"), _c(ts).cast("timestamp_ntz"))
    return F.date_format(ntz, "yyyy-MM-dd HH:mm:ss")


def with_time_features(df, src: str = "pickup_datetime", ts_col: str | None = None):
    """Add ``hour``, ``day_of_week``, ``month`` (INT) from a pickup string column."""
    ts = parse_pickup(src)
    return with_time_parts(df.withColumn(ts_col, ts) if ts_col else df, ts)


def with_time_parts(df, ts):
    """Add ``hour``, ``day_of_week``, ``month`` (INT) of the instant ``ts``."""
    return df.withColumns({"hour": utc_hour(ts), "day_of_week": utc_day_of_week(ts), "month": utc_month(ts)})
