"""JSON message encoding and decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import TRIP_COLUMNS, TRIP_SCHEMA


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def encode(cols: list[str] | None = None) -> Column:
    """Record → JSON text; NULL members are omitted, like absent dict keys (K1)."""
    return F.to_json(F.struct(*[F.col(c) for c in (cols or TRIP_COLUMNS)]))


def decode(value, schema=TRIP_SCHEMA) -> Column:
    """JSON text (or UTF-8 bytes) → struct; missing members are NULL."""
    v = _c(value).cast("string")
    return F.from_json(v, schema)


def is_object(value) -> Column:
    """True when the message is a JSON object (F3), False for anything else.

    One parse: a JSON object (nested members included, bare ``NaN`` accepted as
    Python's encoder writes it) decodes to a map; arrays, scalars, malformed
    text and NULL do not.
    """
    v = _c(value).cast("string")
    return F.coalesce(F.from_json(v, "MAP<STRING,STRING>").isNotNull(), F.lit(False))


def as_object(value, schema=TRIP_SCHEMA) -> Column:
    """The struct of a JSON object, NULL for everything else."""
    v = _c(value).cast("string")
    members = F.from_json(v, "MAP<STRING,STRING>")
    return F.when(members.isNotNull(), F.from_json(v, schema))


CORRUPT = "_corrupt_record"


def decode_text(value, names: list[str]) -> Column:
    """Lenient decode: each member as its JSON text, plus ``_corrupt_record``
    holding the input when it is not a JSON object (malformed, array, scalar)."""
    v = _c(value).cast("string")
    schema = ", ".join([f"`{n}` STRING" for n in names] + [f"{CORRUPT} STRING"])
    return F.from_json(v, schema, {"columnNameOfCorruptRecord": CORRUPT})
