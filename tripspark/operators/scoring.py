"""Scoring request tables or streams by model version.

Every request row gets a status, checked in the original's order:

* ``unknown_model``: its version is not loaded (404);
* ``no_input``: the body is NULL, blank or JSON-falsy (``{}``, ``[]``, …) (400);
* ``bad_input``: not a JSON object, or a member of the wrong type (500);
* ``ok`` with ``predicted_fare``, or ``no_prediction`` if the model yields none.

Routing compares the version with the loaded ones, a list the driver holds anyway (one entry per
loaded model). Each loaded version transforms only its own rows, and the parts are unioned,
so every request passes through exactly one model. A request table partitioned by
``model_version`` (or a persisted micro-batch) is read once in all, whatever the number of models.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codec
from ..functions.geo import DEFAULT_MAX_KM
from ..schemas import REQUEST_SCHEMA
from . import features

# Request status codes.
UNKNOWN_MODEL = "unknown_model"
NO_INPUT = "no_input"
BAD_INPUT = "bad_input"
ACCEPTED = "accepted"
OK = "ok"
NO_PREDICTION = "no_prediction"

# Fixed value: the warning of a request without a prediction.
NO_PREDICTION_WARNING = "Could not generate prediction, possibly due to invalid input features after preprocessing."

# JSON texts that are "falsy" once parsed (after removing whitespace).
FALSY_JSON = ["{}", "[]", '""', "0", "0.0", "false", "null"]

REQUEST_FIELDS = [f.name for f in REQUEST_SCHEMA.fields]


def _type_error(text: Column, parsed: Column) -> Column:
    """A member is present in the text but does not fit its declared type."""
    err = F.lit(False)
    for f in REQUEST_FIELDS:
        err = err | (text[f].isNotNull() & parsed[f].isNull())
    return err


def request_status(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Add ``status`` and the parsed request fields.

    ``registry`` lists loaded versions (``model_version`` column); a version listed twice counts once.
    """
    known = sorted({r[0] for r in registry.select("model_version").collect()} - {None})  # one per loaded model
    df = requests.withColumn("_known", F.when(F.col("model_version").isin(known), F.lit(True)))
    v = F.col("value").cast("string")
    squeezed = F.regexp_replace(v, r"\s", "")
    no_input = v.isNull() | (squeezed == "") | squeezed.isin(FALSY_JSON)
    # Two parses per body: members as text (presence, object-ness) and typed.
    df = df.withColumns({"_txt": codec.decode_text(v, REQUEST_FIELDS), "_req": codec.decode(v, REQUEST_SCHEMA)})
    txt, req = F.col("_txt"), F.col("_req")
    not_object = txt.isNull() | txt[codec.CORRUPT].isNotNull()
    status = (F.when(F.col("_known").isNull(), F.lit(UNKNOWN_MODEL))
               .when(no_input, F.lit(NO_INPUT))
               .when(not_object | _type_error(txt, req), F.lit(BAD_INPUT))
               .otherwise(F.lit(ACCEPTED)))
    return (df.withColumn("status", status)
              .select(*[c for c in requests.columns], "status",
                      *[F.col(f"_req.{f}").alias(f) for f in REQUEST_FIELDS]))


def keeping_rows(model):
    """The same model, but its vector assemblers keep invalid rows instead of dropping them.

    Scoring must return one row per request: a row the training pipeline would
    skip yields a NaN-bearing vector and, through it, ``no_prediction``
    (the original answered such a request with a warning).
    """
    if isinstance(model, PipelineModel):
        return PipelineModel(stages=[keeping_rows(s) for s in model.stages])
    if isinstance(model, VectorAssembler) and model.getHandleInvalid() == "skip":
        return model.copy({model.handleInvalid: "keep"})
    return model


def score(status_df: DataFrame, models: dict[str, PipelineModel],
          max_km: float | None = DEFAULT_MAX_KM, digits: int = 2) -> DataFrame:
    """Predict accepted requests with their version's model.

    One branch per loaded version takes all rows of that version (its filter
    reaches the scan, so each body is parsed once); only accepted rows keep
    their prediction. Rows of other versions need no parsing at all. Output:
    the request columns, ``status`` (final) and ``predicted_fare`` rounded
    half-up to ``digits`` (NULL unless ``ok``).
    """
    base_cols = [c for c in status_df.columns if c not in REQUEST_FIELDS]
    versions = sorted(models)
    accepted = F.col("status") == ACCEPTED
    parts = [
        keeping_rows(models[v]).transform(
            features.add_features(status_df.filter(F.col("model_version") == F.lit(v)), max_km=max_km))
        .select(*base_cols, F.when(accepted, F.col("prediction").cast("double")).alias("prediction"))
        for v in versions
    ]
    others = status_df.filter(~F.col("model_version").isin(versions) | F.col("model_version").isNull())
    rest = others.select(*base_cols, F.lit(None).cast("double").alias("prediction"))
    scored = reduce(lambda a, b: a.unionByName(b), parts, rest)
    pred_ok = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    final = (F.when(F.col("status") != ACCEPTED, F.col("status"))
              .when(pred_ok, F.lit(OK)).otherwise(F.lit(NO_PREDICTION)))
    return (scored.withColumn("status", final)
                  .withColumn("predicted_fare", F.when(pred_ok, features.round_fare("prediction", digits)))
                  .drop("prediction"))


def records(scored: DataFrame, models: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Response records as JSON text (K8): what both services answer to each request.

    ``record``: version, the input as an object (its text if it is none), and the rounded fare, a
    warning (no prediction) or an error. ``record_container``: the container service's form,
    ``model_version_used`` and the fare; for an unknown version the error and ``available_models``.
    """
    name = F.concat(F.lit("fare_model_"), F.col("model_version"))
    status = F.col("status")
    is_object = codec.is_object("value")
    members = F.from_json(F.col("value"), REQUEST_SCHEMA)
    head = [name.alias("model_version")]
    body = lambda *extra: F.to_json(F.struct(*head, members.alias("input_data"), *extra))
    text = lambda *extra: F.to_json(F.struct(*head, F.col("value").alias("input_data"), *extra))
    error = lambda e: F.to_json(F.struct(e.alias("error")))
    shown = F.coalesce(F.col("model_version"), F.lit("None"))
    record = (F.when(status == OK, body(F.col("predicted_fare")))
               .when((status == NO_PREDICTION) & is_object, body(F.lit(NO_PREDICTION_WARNING).alias("warning")))
               .when(status == NO_PREDICTION, text(F.lit(NO_PREDICTION_WARNING).alias("warning")))
               .when(status == UNKNOWN_MODEL, error(F.format_string("Model fare_model_%s not loaded or does not exist", shown)))
               .when(status == NO_INPUT, error(F.lit("No input data provided")))
               .otherwise(error(F.lit("An internal server error occurred: the input does not fit the request schema"))))
    available = F.array(*[F.lit(v) for v in sorted(models)]) if models else F.array().cast("array<string>")
    container = (F.when(status == OK, F.to_json(F.struct(F.col("model_version").alias("model_version_used"), "predicted_fare")))
                  .when(status == UNKNOWN_MODEL, F.to_json(F.struct(
                      F.format_string("Model version '%s' not found or not loaded.", shown).alias("error"), available.alias("available_models"))))
                  .when(status == NO_INPUT, error(F.lit("Invalid input. JSON data is required.")))
                  .otherwise(error(F.lit("Failed to make prediction. Check server logs."))))
    return scored.select("request_id", "status", record.alias("record"), container.alias("record_container"))
