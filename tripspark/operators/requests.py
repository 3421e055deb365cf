"""Request bodies as VARIANT: parsed once, typed members read from the parsed value, the whole input echoed.

``parsed`` adds ``body``, the parsed text (NULL if it is no JSON). ``with_status`` reads the request fields from it: a member fits a DOUBLE
field if it is a number, an INT field if it is a whole number of 32 bits, a STRING field if it is a text; an absent member and a JSON null are NULL.
Members that are not in the schema are no error and stay in ``body``, so ``records`` echoes the input as it came (members in
VARIANT's order, by name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geo import DEFAULT_MAX_KM
from ..schemas import FEATURE_COLUMNS, REQUEST_SCHEMA
from . import ensembles, features
from .scoring import ACCEPTED, BAD_INPUT, NO_INPUT, NO_PREDICTION, NO_PREDICTION_WARNING, OK, REQUEST_FIELDS, UNKNOWN_MODEL

#: Names of the columns in which ``with_status`` keeps the members, their types' names and the body's while it reads them.
_MEMBERS, _KIND = "_members", "_kind"


def parsed(requests: DataFrame, value: str = "value", versions: list[str] | None = None) -> DataFrame:
    """Add ``body``: the request text as VARIANT, NULL if it is not JSON.

    With ``versions``, only requests for these are read, as in the original, which looks for the model before the input; the others' ``body`` is NULL.
    """
    body = F.try_parse_json(F.col(value).cast("string"))
    return requests.withColumn("body", body if versions is None else F.when(F.col("model_version").isin(versions), body))


def _typed(field: T.StructField) -> Column:
    """A field's value if its member's type fits.

    Whole and decimal numbers are read from the member's text, which holds their digits: VARIANT's own conversion to another type makes a new
    cast for each value. Both round a number to the nearest double.
    """
    kind, member = F.col(f"{_KIND}_{field.name}"), F.col(f"{_MEMBERS}.{field.name}")
    if isinstance(field.dataType, T.StringType):
        return F.when(kind == "STRING", F.try_variant_get(member, "$", "string"))
    if isinstance(field.dataType, T.IntegerType):
        return F.when(kind == "BIGINT", F.to_json(member).try_cast("int"))
    return (F.when((kind == "BIGINT") | kind.startswith("DECIMAL("), F.to_json(member).try_cast("double"))
             .when(kind.isin("DOUBLE", "FLOAT"), F.try_variant_get(member, "$", "double")))


def with_status(requests: DataFrame, versions: list[str]) -> DataFrame:
    """``requests`` (with ``body``, see ``parsed``) with ``status`` and the request fields; ``versions``: the loaded ones.

    Each step is a projection of its own whose columns later ones refer to: members are taken from the body at once, and a member's type and
    value are found once, not for each place that asks for them.
    """
    text = F.col("value").cast("string")
    names = [f.name for f in REQUEST_SCHEMA.fields]
    members = ", ".join(f"`{n}`: variant" for n in names)
    rows = requests.withColumn(_MEMBERS, F.try_variant_get("body", "$", f"struct<{members}>"))  # NULL if the body is no object
    of = {n: F.col(f"{_MEMBERS}.{n}") for n in names}
    # an object with one of the fields is neither empty nor anything else; the type of the whole body is named for the others only
    other = F.when(F.coalesce(*[F.when(c.isNotNull(), F.lit(1)) for c in of.values()]).isNull(), F.schema_of_variant("body"))
    rows = rows.withColumns({f"{_KIND}_{n}": F.schema_of_variant(c) for n, c in of.items()} | {_KIND: other})
    rows = rows.withColumns({f.name: _typed(f) for f in REQUEST_SCHEMA.fields})
    kind, is_object = F.col(_KIND), F.col(_MEMBERS).isNotNull()
    # what Python takes as false: an empty object, list or text, zero, false, null; or no text at all
    falsy = kind.isin("OBJECT<>", "ARRAY<VOID>", "ARRAY<>", "VOID") | F.coalesce(
        ~is_object & ~kind.startswith("ARRAY") & F.try_variant_get("body", "$", "string").isin("", "0", "0.0", "false"), F.lit(False))
    no_input = text.isNull() | (F.trim(text) == "") | F.coalesce(falsy, F.lit(False))
    bad = ~is_object
    for n in names:  # a member is there but doesn't fit
        bad = bad | F.coalesce((F.col(f"{_KIND}_{n}") != "VOID") & F.col(n).isNull(), F.lit(False))
    status = (F.when(~F.coalesce(F.col("model_version").isin(versions), F.lit(False)), F.lit(UNKNOWN_MODEL))
               .when(no_input, F.lit(NO_INPUT)).when(bad, F.lit(BAD_INPUT)).otherwise(F.lit(ACCEPTED)))
    return rows.select(*requests.columns, status.alias("status"), *names)


def score(status_df: DataFrame, models: DataFrame, max_km: float | None = DEFAULT_MAX_KM, digits: int = 2, spread: str = "request_id") -> DataFrame:
    """Final ``status`` and ``predicted_fare`` of every request in one pass over them, whatever the number of versions in ``models``
    (``ensembles.packed_models``); the request fields are dropped."""
    kept = [c for c in status_df.columns if c not in REQUEST_FIELDS]
    accepted = F.col("status") == ACCEPTED
    scored = ensembles.predict(features.add_features(status_df, max_km=max_km), models, FEATURE_COLUMNS, spread, accepted)
    there = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    final = F.when(~accepted, F.col("status")).when(there, F.lit(OK)).otherwise(F.lit(NO_PREDICTION))
    return scored.select(*[c for c in kept if c != "status"], final.alias("status"), F.when(accepted & there, features.round_fare("prediction", digits)).alias("predicted_fare"))


def records(scored: DataFrame) -> DataFrame:
    """Response records with the whole input: ``record`` as of the first service (K8, V3); needs ``body``."""
    name = F.concat(F.lit("fare_model_"), F.col("model_version"))
    head = [name.alias("model_version"), F.col("body").alias("input_data")]
    error = lambda e: F.to_json(F.struct(e.alias("error")))
    status = F.col("status")
    record = (F.when(status == OK, F.to_json(F.struct(*head, "predicted_fare")))
               .when(status == NO_PREDICTION, F.to_json(F.struct(*head, F.lit(NO_PREDICTION_WARNING).alias("warning"))))
               # fixed values: the service's error texts
               .when(status == UNKNOWN_MODEL, error(F.format_string("Model fare_model_%s not loaded or does not exist", F.coalesce("model_version", F.lit("None")))))
               .when(status == NO_INPUT, error(F.lit("No input data provided")))
               .otherwise(error(F.lit("An internal server error occurred: the input does not fit the request schema"))))
    return scored.select("request_id", "status", record.alias("record"))
