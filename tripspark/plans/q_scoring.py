"""Registered queries: request parsing, routing, status and scoring (§2.5, §2.11, M9-M10, K8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codec
from ..operators import ensembles, gram, requests as bodies, scoring, training
from ..schemas import BASIC_FEATURE_COLUMNS, REQUEST_SCHEMA
from ..session import scratch_path
from ..sources import models as registry
from . import frames
from .lr_sql import regressed
from .oracle_base import with_pipeline
from .registry import query

REQ_FIELDS = [f.name for f in REQUEST_SCHEMA.fields]
_EMPTY = "row_no % 17 = 0 OR row_no % 19 = 0 OR row_no % 23 = 0"
_N_MODELS = "(SELECT least(3, count(DISTINCT batch_no)) FROM b)"
_KNOWN = f"CAST(substr(model_version, 2) AS INTEGER) <= {_N_MODELS}"
REQ_CTES = f"""
req AS (SELECT row_no AS request_id,
  CASE WHEN row_no % 10 = 9 THEN 'v9' ELSE 'v' || CAST(row_no % 3 + 1 AS VARCHAR) END AS model_version, *
  FROM sent),
st AS (SELECT *, CASE WHEN NOT {_KNOWN} THEN 'unknown_model'
  WHEN row_no % 17 = 0 OR row_no % 19 = 0 THEN 'no_input'
  WHEN row_no % 23 = 0 THEN 'bad_input' ELSE 'accepted' END AS status FROM req)
"""


def _registry(spark, sf_dir):
    models_dir, _ = frames.trained_models(spark, sf_dir)
    reg, models = registry.load_expected(spark, models_dir, 3)
    return registry.loaded_versions(reg), models


def _status(spark, sf_dir):
    reg, models = _registry(spark, sf_dir)
    return scoring.request_status(frames.requests(spark, sf_dir), reg), models


@query("requests_from_json", with_pipeline(
    "SELECT request_id, " + ", ".join(f"CASE WHEN {_EMPTY} THEN NULL ELSE {c} END AS {c}" for c in REQ_FIELDS)
    + " FROM req", REQ_CTES))
def requests_from_json(spark, sf_dir):
    """Request bodies → typed columns with the fixed request schema; absent members NULL."""
    r = frames.requests(spark, sf_dir)
    return r.select("request_id", codec.decode("value", REQUEST_SCHEMA).alias("q")).select("request_id", "q.*")


@query("requests_infer", with_pipeline(
    "SELECT " + ", ".join(f"CASE WHEN {_EMPTY} THEN NULL ELSE {c} END AS {c}" for c in REQ_FIELDS)
    + ", row_no % 23 = 0 AND NOT (row_no % 17 = 0 OR row_no % 19 = 0) AS is_corrupt, row_no % 17 = 0 AS is_null FROM req",
    REQ_CTES))
def requests_infer(spark, sf_dir):
    """Request bodies read as JSON lines with an inferred schema."""
    path = scratch_path(spark, "requests_json")
    bodies = frames.requests(spark, sf_dir).select("value")
    bodies.filter(F.col("value").isNotNull()).write.mode("overwrite").text(path)
    df = spark.read.json(path)
    corrupt = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in df.columns else F.lit(False)
    cols = []
    for f in REQUEST_SCHEMA.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None).cast("string")
        cols.append(c.try_cast(f.dataType).alias(f.name))
    # a NULL body is no JSON line; its row stays, flagged
    none = bodies.filter(F.col("value").isNull()).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in REQUEST_SCHEMA.fields], F.lit(False).alias("is_corrupt"), F.lit(True).alias("is_null"))
    return df.select(*cols, corrupt.alias("is_corrupt"), F.lit(False).alias("is_null")).unionByName(none)


@query("route_requests", with_pipeline(
    f"SELECT request_id, model_version, {_KNOWN} AS routed FROM req", REQ_CTES))
def route_requests(spark, sf_dir):
    """Each request with whether its version is loaded."""
    _, models = _registry(spark, sf_dir)
    known = F.coalesce(F.col("model_version").isin(sorted(models)), F.lit(False))
    return frames.requests(spark, sf_dir).select("request_id", "model_version", known.alias("routed"))


@query("unknown_versions", with_pipeline(
    "SELECT request_id, model_version, (SELECT string_agg('v' || CAST(i AS VARCHAR), ',' ORDER BY i) "
    f"FROM range(1, 1 + {_N_MODELS}) t(i)) AS available_models FROM req WHERE NOT {_KNOWN}", REQ_CTES))
def unknown_versions(spark, sf_dir):
    """Requests for versions that are not loaded, with the available list."""
    _, models = _registry(spark, sf_dir)
    # The list comes from the driver-side model map (one entry per loaded version).
    available = ",".join(sorted(models))
    known = F.coalesce(F.col("model_version").isin(sorted(models)), F.lit(False))
    return frames.requests(spark, sf_dir).filter(~known).select("request_id", "model_version", F.lit(available).alias("available_models"))


@query("request_status", with_pipeline("SELECT request_id, status FROM st", REQ_CTES))
def request_status(spark, sf_dir):
    """Validation status of every request (V1, V2, V4)."""
    st, _ = _status(spark, sf_dir)
    return st.select("request_id", "status")


@query("score_by_version", with_pipeline(
    "SELECT model_version, CASE WHEN status = 'accepted' THEN 'ok' ELSE status END AS status, "
    "count(*) AS n_requests FROM st GROUP BY ALL", REQ_CTES))
def score_by_version(spark, sf_dir):
    """Requests per version and final status after scoring."""
    st, models = _status(spark, sf_dir)
    return (scoring.score(st, models).groupBy("model_version", "status")
            .agg(F.count(F.lit(1)).alias("n_requests")))


# The distance model of each version in closed form, and the fare it gives each accepted request.
FARE_CTES = REQ_CTES.rstrip() + """,
coef AS (SELECT CAST(t.v AS INTEGER) AS v, regr_slope(fare_amount, distance_km) AS s, regr_intercept(fare_amount, distance_km) AS i,
         avg(distance_km) AS m FROM g JOIN range(1, 4) t(v) ON g.batch_no <= t.v GROUP BY t.v),
fare AS (SELECT st.*, CASE WHEN status = 'accepted' THEN round(i + s * coalesce(f.distance_km, m), 2) END AS predicted_fare
         FROM st JOIN f ON f.row_no = st.row_no LEFT JOIN coef ON 'v' || CAST(coef.v AS VARCHAR) = st.model_version)
"""


def _distance_scores(spark, sf_dir):
    """All requests scored by linear models of the distance, one for each cumulative version."""
    models_dir, _ = frames.trained_models(spark, sf_dir, kind="lr_plain", input_cols=["distance_km"])
    reg, models = registry.load_expected(spark, models_dir, 3)
    return scoring.score(scoring.request_status(frames.requests(spark, sf_dir), registry.loaded_versions(reg)), models), models


@query("score_batch", with_pipeline(
    "SELECT request_id, model_version, CASE WHEN status = 'accepted' THEN 'ok' ELSE status END AS status, predicted_fare FROM fare",
    FARE_CTES))
def score_batch(spark, sf_dir):
    """Every request scored by its version's model; fare rounded half-up to cents."""
    return _distance_scores(spark, sf_dir)[0].select("request_id", "model_version", "status", "predicted_fare")


_OK = "status = 'accepted'"
_RECORD_SQL = ", ".join(f"CASE WHEN {_OK} THEN {c} END AS in_{c}" for c in REQ_FIELDS)


@query("score_records", with_pipeline(f"""
SELECT request_id, CASE WHEN {_OK} THEN 'fare_model_' || model_version END AS model_version, {_RECORD_SQL}, predicted_fare,
  CASE status WHEN 'unknown_model' THEN 'Model fare_model_' || model_version || ' not loaded or does not exist'
              WHEN 'no_input' THEN 'No input data provided'
              WHEN 'bad_input' THEN 'An internal server error occurred: the input does not fit the request schema' END AS error,
  CAST(NULL AS VARCHAR) AS warning, CASE WHEN {_OK} THEN model_version END AS model_version_used, predicted_fare AS container_fare,
  CASE status WHEN 'unknown_model' THEN 'Model version ''' || model_version || ''' not found or not loaded.'
              WHEN 'no_input' THEN 'Invalid input. JSON data is required.'
              WHEN 'bad_input' THEN 'Failed to make prediction. Check server logs.' END AS container_error,
  CASE WHEN status = 'unknown_model' THEN (SELECT string_agg('v' || CAST(i AS VARCHAR), ',' ORDER BY i)
       FROM range(1, 1 + {_N_MODELS}) t(i)) END AS available_models
FROM fare""", FARE_CTES))
def score_records(spark, sf_dir):
    """Response records of both services (K8, V2, V3), checked through every member read back."""
    scored, models = _distance_scores(spark, sf_dir)
    recs = scoring.records(scored, sorted(models))
    fields = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in REQUEST_SCHEMA.fields)
    a = F.from_json("record", f"model_version STRING, input_data struct<{fields}>, predicted_fare DOUBLE, error STRING, warning STRING")
    b = F.from_json("record_container", "model_version_used STRING, predicted_fare DOUBLE, error STRING, available_models array<string>")
    return (recs.select("request_id", a.alias("a"), b.alias("b"))
            .select("request_id", "a.model_version", *[F.col(f"a.input_data.{c}").alias(f"in_{c}") for c in REQ_FIELDS], "a.predicted_fare",
                    "a.error", "a.warning", "b.model_version_used", F.col("b.predicted_fare").alias("container_fare"),
                    F.col("b.error").alias("container_error"), F.array_join("b.available_models", ",").alias("available_models")))


# --- one pass for all versions ------------------------------------------------------------

def _packed(spark, models_dir, models):
    return ensembles.packed_models(spark, [training.model_path(models_dir, int(v[1:])) for v in sorted(models)])


def _packed_distance_scores(spark, sf_dir):
    models_dir, _ = frames.trained_models(spark, sf_dir, kind="lr_plain", input_cols=["distance_km"])
    _, models = registry.load_expected(spark, models_dir, 3)
    status = bodies.with_status(bodies.parsed(frames.requests(spark, sf_dir)), sorted(models))
    return bodies.score(status, _packed(spark, models_dir, models))


@query("score_packed", with_pipeline(
    "SELECT request_id, model_version, CASE WHEN status = 'accepted' THEN 'ok' ELSE status END AS status, predicted_fare FROM fare", FARE_CTES))
def score_packed(spark, sf_dir):
    """Every request parsed once as VARIANT and scored in one pass, its version a join key."""
    return _packed_distance_scores(spark, sf_dir).select("request_id", "model_version", "status", "predicted_fare")


@query("score_by_version_fares", with_pipeline(
    "SELECT model_version, CASE WHEN status = 'accepted' THEN 'ok' ELSE status END AS status, count(*) AS n_requests, "
    "round(sum(predicted_fare), 2) AS fares, max(predicted_fare) AS highest FROM fare GROUP BY ALL", FARE_CTES))
def score_by_version_fares(spark, sf_dir):
    """Requests, sum of fares and highest fare of each version and status."""
    return _packed_distance_scores(spark, sf_dir).groupBy("model_version", "status").agg(
        F.count(F.lit(1)).alias("n_requests"), F.round(F.sum("predicted_fare"), 2).alias("fares"), F.max("predicted_fare").alias("highest"))


@query("score_packed_agrees", with_pipeline("SELECT count(*) AS n_requests, CAST(count_if(status = 'accepted') AS BIGINT) AS n_fares, CAST(0 AS BIGINT) AS n_differences FROM st", REQ_CTES))
def score_packed_agrees(spark, sf_dir):
    """The tree models' fares of every request, in one pass and through each version's pipeline: no row differs by more than a cent of rounding."""
    models_dir, _ = frames.trained_models(spark, sf_dir)
    reg, models = registry.load_expected(spark, models_dir, 3)
    rows = frames.requests(spark, sf_dir)
    one = bodies.score(bodies.with_status(bodies.parsed(rows), sorted(models)), _packed(spark, models_dir, models), digits=6)
    each = scoring.score(scoring.request_status(rows, registry.loaded_versions(reg)), models, digits=6)
    both = one.join(each.select("request_id", F.col("status").alias("s"), F.col("predicted_fare").alias("p")), "request_id", "full")
    same = F.col("status").eqNullSafe(F.col("s")) & (F.col("predicted_fare").eqNullSafe(F.col("p")) | (F.abs(F.col("predicted_fare") - F.col("p")) < 1e-5))
    return both.agg(F.count(F.lit(1)).alias("n_requests"), F.count("predicted_fare").alias("n_fares"), F.count_if(~F.coalesce(same, F.lit(False))).alias("n_differences"))


@query("version_names", with_pipeline(
    "SELECT model_version, 'fare_model_' || model_version AS model_name, model_version AS parsed, CAST(substr(model_version, 2) AS INTEGER) AS number, "
    "count(*) AS n_requests FROM req GROUP BY model_version", REQ_CTES))
def version_names(spark, sf_dir):
    """Model names of the requested versions, and the version read back from the name."""
    name = F.concat(F.lit("fare_model_"), F.col("model_version"))
    back = F.element_at(F.split("model_name", "_"), -1)
    return (frames.requests(spark, sf_dir).groupBy("model_version").agg(F.count(F.lit(1)).alias("n_requests")).withColumn("model_name", name)
            .select("model_version", "model_name", back.alias("parsed"), F.substring(back, 2, 9).cast("int").alias("number"), "n_requests"))


# --- bodies with more, fewer and other members ---------------------------------------------

_OPEN_CTES = f"""
opened AS (SELECT row_no AS request_id, CASE WHEN row_no % 10 = 9 THEN 'v9' ELSE 'v' || CAST(row_no % 3 + 1 AS VARCHAR) END AS model_version,
  sent.*, row_no % 17 = 0 AS no_body, row_no % 29 = 0 AS lacks, row_no % 31 = 0 AS wrong, row_no % 13 = 0 AS more FROM sent),
told AS (SELECT *, CASE WHEN NOT {_KNOWN} THEN 'unknown_model' WHEN no_body THEN 'no_input' WHEN wrong AND NOT lacks THEN 'bad_input' ELSE 'accepted' END AS status FROM opened),
fitted AS (SELECT CAST(t.v AS INTEGER) AS v, row_no, fare_amount AS y, 1 AS w, {", ".join(BASIC_FEATURE_COLUMNS)} FROM g JOIN range(1, 4) t(v) ON g.batch_no <= t.v
  UNION ALL SELECT CAST(substr(model_version, 2) AS INTEGER), -1 - row_no, 0, 0, {", ".join(c if c != "passenger_count" else "CASE WHEN NOT lacks THEN passenger_count END" for c in BASIC_FEATURE_COLUMNS)}
  FROM told WHERE status = 'accepted'),
{regressed("fitted", BASIC_FEATURE_COLUMNS, training.LR_REG_PARAM)},
answered AS (SELECT told.*, prediction, CASE WHEN status <> 'accepted' THEN status WHEN prediction IS NULL THEN 'no_prediction' ELSE 'ok' END AS final
  FROM told LEFT JOIN regression ON regression.row_no = -1 - told.row_no)
"""


def _open_requests(spark, sf_dir):
    """Bodies of accepted trips; some lack the passengers, have them as text, have other members too, or are NULL (stand-in for free input)."""
    trips = frames.sent(spark, sf_dir)
    n = F.col("row_no")
    version = F.when(n % 10 == 9, F.lit("v9")).otherwise(F.format_string("v%d", n % 3 + 1))
    number, text = F.when(n % 31 != 0, F.col("passenger_count")), F.when(n % 31 == 0, F.col("passenger_count").cast("string"))
    fields = [c for c in REQ_FIELDS if c != "passenger_count"]
    shared = F.struct(*fields, F.when(n % 29 != 0, number).alias("passenger_count"), F.when(n % 13 == 0, F.lit(1.5)).alias("tip"),
                      F.when(n % 13 == 0, F.struct(F.array(F.lit(1), F.lit(2)).alias("path"))).alias("note"))
    other = F.struct(*fields, F.when(n % 29 != 0, text).alias("passenger_count"), F.when(n % 13 == 0, F.lit(1.5)).alias("tip"),
                     F.when(n % 13 == 0, F.struct(F.array(F.lit(1), F.lit(2)).alias("path"))).alias("note"))
    value = F.when(n % 17 == 0, None).when(n % 31 == 0, F.to_json(other)).otherwise(F.to_json(shared))
    return trips.select(n.alias("request_id"), version.alias("model_version"), value.alias("value"))


@query("requests_variant", with_pipeline(
    "SELECT request_id, status, " + ", ".join(f"CASE WHEN no_body{' OR lacks OR wrong' if c == 'passenger_count' else ''} THEN NULL ELSE {c} END AS {c}" for c in REQ_FIELDS)
    + ", CASE WHEN more AND NOT no_body THEN CAST(1.5 AS DOUBLE) END AS tip, CASE WHEN more AND NOT no_body THEN 2 END AS second FROM told", _OPEN_CTES))
def requests_variant(spark, sf_dir):
    """Free-form bodies parsed once as VARIANT: typed request fields, statuses, and members outside the schema."""
    rows = bodies.with_status(bodies.parsed(_open_requests(spark, sf_dir)), _versions(spark, sf_dir))
    return rows.select("request_id", "status", *REQ_FIELDS, F.try_variant_get("body", "$.tip", "double").alias("tip"),
                       F.try_variant_get("body", "$.note.path[1]", "int").alias("second"))


def _versions(spark, sf_dir):
    """The first three versions that have a batch."""
    return [f"v{r.version}" for r in frames.trained_models(spark, sf_dir)[1].filter("status = 'saved'").select("version").collect()]


@query("score_records_whole", with_pipeline("""
SELECT request_id, final AS status, CASE WHEN final IN ('ok', 'no_prediction') THEN 'fare_model_' || model_version END AS model_version,
  CASE WHEN final = 'ok' THEN round(prediction, 2) END AS predicted_fare,
  CASE WHEN final = 'no_prediction' THEN 'Could not generate prediction, possibly due to invalid input features after preprocessing.' END AS warning,
  CASE final WHEN 'unknown_model' THEN 'Model fare_model_' || model_version || ' not loaded or does not exist' WHEN 'no_input' THEN 'No input data provided'
             WHEN 'bad_input' THEN 'An internal server error occurred: the input does not fit the request schema' END AS error,
  CASE WHEN final IN ('ok', 'no_prediction') THEN pickup_longitude END AS in_longitude, CASE WHEN final IN ('ok', 'no_prediction') AND NOT lacks THEN passenger_count END AS in_passengers,
  CASE WHEN final IN ('ok', 'no_prediction') AND more THEN CAST(1.5 AS DOUBLE) END AS in_tip, CASE WHEN final IN ('ok', 'no_prediction') AND more THEN '[1,2]' END AS in_path
FROM answered""", _OPEN_CTES))
def score_records_whole(spark, sf_dir):
    """Records that echo the whole input, members outside the schema included; a body without passengers gets the warning from models that
    don't impute (K8, V3, M6: regularised models of three versions from the batches' sums; the first batches' coordinates are collinear)."""
    trained = frames.cleaned(spark, sf_dir, batch=True).filter(F.col("batch_no") <= 3)
    models = gram.packed(gram.fit_versions(trained, BASIC_FEATURE_COLUMNS, reg=training.LR_REG_PARAM), BASIC_FEATURE_COLUMNS)
    status = bodies.with_status(bodies.parsed(_open_requests(spark, sf_dir)), sorted(r[0] for r in models.select("model_version").collect()))
    record = bodies.records(bodies.score(status, models))
    at = lambda path: F.get_json_object("record", path)
    return record.select("request_id", "status", at("$.model_version").alias("model_version"), at("$.predicted_fare").cast("double").alias("predicted_fare"),
                         at("$.warning").alias("warning"), at("$.error").alias("error"), at("$.input_data.pickup_longitude").cast("double").alias("in_longitude"),
                         at("$.input_data.passenger_count").cast("int").alias("in_passengers"), at("$.input_data.tip").cast("double").alias("in_tip"),
                         at("$.input_data.note.path").alias("in_path"))
