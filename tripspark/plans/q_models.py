"""Registered queries: feature stages, models, versions, registry (§2.8, S12-S15, A4-A5)."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import batching, ensembles, features, gram, training, versions
from ..schemas import BASIC_FEATURE_COLUMNS, FEATURE_COLUMNS, LABEL
from ..session import copy_head, list_dir, scratch_path
from ..sources import files, quarantine
from ..sources import models as registry
from . import frames
from .gbt_sql import boosted
from .lr_sql import regressed
from .oracle_base import with_pipeline
from .registry import query

INT_FEATURES = {"passenger_count", "hour", "day_of_week", "month"}


def _r(c, digits=6):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# --- feature stages ------------------------------------------------------------

@query("impute_means", with_pipeline(
    "SELECT " + ", ".join(f"round(avg({c}), 6) AS mean_{c}" for c in FEATURE_COLUMNS) + " FROM g"))
def impute_means(spark, sf_dir):
    """Mean of each feature over the training rows: one Imputer, one aggregate (A4)."""
    imp = Imputer(inputCols=FEATURE_COLUMNS, outputCols=[f"{c}_i" for c in FEATURE_COLUMNS], strategy="mean")
    model = imp.fit(frames.cleaned(spark, sf_dir))
    return model.surrogateDF.select(*[_r(c).alias(f"mean_{c}") for c in FEATURE_COLUMNS])


def _impute_sql():
    cols = []
    for c in FEATURE_COLUMNS:
        if c in INT_FEATURES:
            cols.append(f"coalesce({c}, (SELECT CAST(trunc(avg({c})) AS INTEGER) FROM g)) AS {c}")
        else:
            cols.append(f"round(coalesce({c}, (SELECT avg({c}) FROM g)), 6) AS {c}")
    return "SELECT row_no, " + ", ".join(cols) + " FROM f"


@query("impute_apply", with_pipeline(_impute_sql()))
def impute_apply(spark, sf_dir):
    """Means learned on clean rows fill NULLs of all trips; INT columns truncate."""
    out = [training.imputed_name(c) for c in FEATURE_COLUMNS]
    model = Imputer(inputCols=FEATURE_COLUMNS, outputCols=out, strategy="mean").fit(frames.cleaned(spark, sf_dir))
    f = model.transform(frames.featured(spark, sf_dir))
    return f.select("row_no", *[(F.col(o) if c in INT_FEATURES else _r(o)).alias(c)
                                for c, o in zip(FEATURE_COLUMNS, out)])


@query("assemble_features", with_pipeline(
    "SELECT row_no, CAST(9 AS INTEGER) AS n_features, "
    + ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in FEATURE_COLUMNS)
    + " FROM f WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLUMNS)))
def assemble_features(spark, sf_dir):
    """Vector assembly with invalid rows skipped (M2); checked through the vector's elements."""
    va = VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features", handleInvalid="skip")
    v = va.transform(frames.featured(spark, sf_dir)).select("row_no", vector_to_array("features").alias("a"))
    return v.select("row_no", F.size("a").alias("n_features"),
                    *[_r(F.col("a")[i]).alias(c) for i, c in enumerate(FEATURE_COLUMNS)])


@query("scale_features", with_pipeline(
    "SELECT row_no, round((passenger_count - avg(passenger_count) OVER ()) / stddev_samp(passenger_count) OVER (), 6)"
    " AS passenger_count_scaled, round((distance_km - avg(distance_km) OVER ()) / stddev_samp(distance_km) OVER (), 6)"
    " AS distance_km_scaled FROM g"))
def scale_features(spark, sf_dir):
    """Standard scaling with mean and sample deviation (M3, optional stage)."""
    stages = training.feature_stages(FEATURE_COLUMNS, "features", scale=True, impute=False)
    c = frames.cleaned(spark, sf_dir)
    v = Pipeline(stages=stages).fit(c).transform(c)
    a = vector_to_array("features")
    return v.select("row_no", _r(a[4]).alias("passenger_count_scaled"), _r(a[8]).alias("distance_km_scaled"))


# --- models -------------------------------------------------------------------

def _distance_lr(spark, sf_dir):
    c = frames.cleaned(spark, sf_dir)
    v = VectorAssembler(inputCols=["distance_km"], outputCol="features").transform(c)
    return LinearRegression(featuresCol="features", labelCol=LABEL).fit(v), v


@query("lr_distance", with_pipeline(
    "SELECT round(regr_slope(fare_amount, distance_km), 6) AS slope, "
    "round(regr_intercept(fare_amount, distance_km), 6) AS intercept FROM g"))
def lr_distance(spark, sf_dir):
    """Linear regression of fare on distance, unregularized (M6)."""
    model, _ = _distance_lr(spark, sf_dir)
    return spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "slope DOUBLE, intercept DOUBLE") \
        .select(_r("slope").alias("slope"), _r("intercept").alias("intercept"))


@query("lr_reload_scores", with_pipeline(
    "SELECT row_no, round((SELECT regr_intercept(fare_amount, distance_km) FROM g) "
    "+ (SELECT regr_slope(fare_amount, distance_km) FROM g) * distance_km, 4) AS prediction FROM g"))
def lr_reload_scores(spark, sf_dir):
    """Save a plain linear model (no overwrite), load it back, score."""
    model, v = _distance_lr(spark, sf_dir)
    path = scratch_path(spark, "lr_model") + "/taxi_fare_model"
    model.save(path)
    loaded = registry.load_linear_model(path)
    return loaded.transform(v).select("row_no", _r("prediction", 4).alias("prediction"))


@query("gbt_stump", with_pipeline("""
SELECT CAST(pv.p AS INTEGER) AS passenger_count,
       round(CASE WHEN pv.p <= best.t THEN best.sl / best.nl ELSE best.sr / best.nr END, 6) AS prediction
FROM pv JOIN best ON true""", """
pv AS (SELECT passenger_count AS p, count(*) AS n, sum(fare_amount) AS s FROM g GROUP BY passenger_count),
mids AS (SELECT (p + lead(p) OVER (ORDER BY p)) / 2.0 AS t FROM pv),
cand AS (SELECT m.t, sum(CASE WHEN pv.p <= m.t THEN pv.n END) AS nl, sum(CASE WHEN pv.p <= m.t THEN pv.s END) AS sl,
                sum(CASE WHEN pv.p > m.t THEN pv.n END) AS nr, sum(CASE WHEN pv.p > m.t THEN pv.s END) AS sr
         FROM mids m JOIN pv ON m.t IS NOT NULL GROUP BY m.t),
best AS (SELECT * FROM cand ORDER BY sl * sl / nl + sr * sr / nr DESC, t LIMIT 1)"""))
def gbt_stump(spark, sf_dir):
    """One boosting round of depth 1 on passenger count: best midpoint split, leaf means (M5)."""
    c = frames.cleaned(spark, sf_dir)
    va = VectorAssembler(inputCols=["passenger_count"], outputCol="features")
    gbt = GBTRegressor(featuresCol="features", labelCol=LABEL, maxIter=1, maxDepth=1, seed=training.DEFAULT_SEED)
    model = Pipeline(stages=[va, gbt]).fit(c)
    grid = c.select("passenger_count").distinct()
    return model.transform(grid).select("passenger_count", _r("prediction").alias("prediction"))


_BASIC_ROWS = "fitted AS (SELECT 0 AS v, row_no, fare_amount AS y, 1 AS w, " + ", ".join(BASIC_FEATURE_COLUMNS) + " FROM b),\n"
_NINE_ROWS = "fitted AS (SELECT 0 AS v, row_no, fare_amount AS y, 1 AS w, " + ", ".join(FEATURE_COLUMNS) + " FROM g),\n"
_VERSION_ROWS = ("fitted AS (SELECT CAST(t.v AS INTEGER) AS v, row_no, fare_amount AS y, 1 AS w, " + ", ".join(FEATURE_COLUMNS)
                 + " FROM g JOIN range(1, 4) t(v) ON g.batch_no <= t.v),\n")
_BASIC_SQL = with_pipeline("SELECT row_no, round(prediction, 4) AS prediction FROM regression", _BASIC_ROWS + regressed("fitted", BASIC_FEATURE_COLUMNS))


@query("lr_basic_scores", _BASIC_SQL)
def lr_basic_scores(spark, sf_dir):
    """Docs-variant trainer: every batch file with an inferred schema, NULL rows dropped,
    five raw features, plain linear regression saved without overwrite, reloaded, applied
    (S8, N7, P13b, M6, K7, S13)."""
    df = files.read_batches_inferred(spark, frames.ingest_batches(spark, sf_dir)).dropna()
    v = VectorAssembler(inputCols=BASIC_FEATURE_COLUMNS, outputCol="features").transform(df)
    path = scratch_path(spark, "lr_basic") + "/taxi_fare_model"
    training.regressor("lr_plain").fit(v).save(path)
    loaded = registry.load_linear_model(path)
    return loaded.transform(v).select(F.col("row_no").cast("bigint").alias("row_no"),
                                      _r("prediction", 4).alias("prediction"))


@query("lr_basic_gram", _BASIC_SQL)
def lr_basic_gram(spark, sf_dir):
    """The docs-variant model from one aggregate of sums and products, scored as a native expression (M6)."""
    rows = files.read_batches_inferred(spark, frames.ingest_batches(spark, sf_dir)).dropna()
    coef, intercept, _ = gram.fit(rows, BASIC_FEATURE_COLUMNS)
    return gram.score(rows, BASIC_FEATURE_COLUMNS, coef, intercept).select(F.col("row_no").cast("bigint").alias("row_no"), _r("prediction", 4).alias("prediction"))


@query("lr_ridge_scores", with_pipeline("SELECT row_no, round(prediction, 4) AS prediction FROM regression",
                                        _NINE_ROWS + regressed("fitted", FEATURE_COLUMNS, training.LR_REG_PARAM)))
def lr_ridge_scores(spark, sf_dir):
    """The commented variant: full pipeline with the regularised linear regression over nine features (M6, M7)."""
    rows = frames.cleaned(spark, sf_dir)
    return training.fit_pipeline(rows, kind="lr").transform(rows).select("row_no", _r("prediction", 4).alias("prediction"))


@query("lr_versions_gram", with_pipeline("SELECT v AS version, row_no, round(prediction, 4) AS prediction FROM regression",
                                         _VERSION_ROWS + regressed("fitted", FEATURE_COLUMNS, training.LR_REG_PARAM)))
def lr_versions_gram(spark, sf_dir):
    """Regularised models of the first three cumulative versions from the batches' sums, one scan; version k scores its rows."""
    rows = frames.cleaned(spark, sf_dir, batch=True).filter(F.col("batch_no") <= 3)
    models = gram.fit_versions(rows, FEATURE_COLUMNS, reg=training.LR_REG_PARAM)
    parts = [gram.score(rows.filter(F.col("batch_no") <= m.batch_no), FEATURE_COLUMNS, m.coefficients, m.intercept)
             .select(F.lit(m.batch_no).alias("version"), "row_no", _r("prediction", 4).alias("prediction")) for m in models.collect()]
    return reduce(DataFrame.unionByName, parts)


_X = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in FEATURE_COLUMNS) + "]"
_GBT_SQL = with_pipeline("SELECT row_no, round(pred, 4) AS prediction FROM boost",
                         f"fitted AS MATERIALIZED (SELECT 0 AS v, row_no, fare_amount AS y, 1 AS w, {_X} AS x FROM g),\n" + boosted("fitted"))


@query("gbt_scores", _GBT_SQL)
def gbt_scores(spark, sf_dir):
    """Full pipeline (imputer, assembler, GBT × 20) fitted on all cleaned rows, scoring each (M5, M7, M9)."""
    rows = frames.cleaned(spark, sf_dir)
    return training.fit_pipeline(rows, kind="gbt").transform(rows).select("row_no", _r("prediction", 4).alias("prediction"))


def _saved_gbt(spark, sf_dir):
    """The full model fitted on all cleaned rows, saved; its folder is named like a version's."""
    path = scratch_path(spark, "gbt_saved") + f"/{training.MODEL_PREFIX}1"
    training.fit_pipeline(frames.cleaned(spark, sf_dir), kind="gbt").write().overwrite().save(path)
    return path


@query("gbt_expression_scores", _GBT_SQL)
def gbt_expression_scores(spark, sf_dir):
    """The saved model's node table compiled to one native column expression (M5, M9, K6)."""
    nodes = ensembles.node_table(spark, [_saved_gbt(spark, sf_dir)])
    e = ensembles.tree_expression(nodes, [F.col(c).cast("double") for c in FEATURE_COLUMNS])
    return frames.cleaned(spark, sf_dir).select("row_no", _r(e, 4).alias("prediction"))


@query("gbt_version_scores", with_pipeline(
    "SELECT v AS version, row_no, round(pred, 4) AS prediction FROM boost",
    f"fitted AS MATERIALIZED (SELECT CAST(t.v AS INTEGER) AS v, row_no, fare_amount AS y, 1 AS w, {_X} AS x FROM g JOIN range(1, 4) t(v) ON g.batch_no <= t.v),\n"
    + boosted("fitted")))
def gbt_version_scores(spark, sf_dir):
    """Trained versions 1 to 3 as one packed table, each scoring the rows it was trained on in one pass."""
    models_dir, summary = frames.trained_models(spark, sf_dir)
    versions = [r.version for r in summary.filter("status = 'saved'").select("version").collect()]
    models = ensembles.packed_models(spark, [training.model_path(models_dir, v) for v in versions])
    rows = frames.cleaned(spark, sf_dir, batch=True).filter(F.col("batch_no") <= max(versions, default=0))
    each = rows.withColumn("version", F.explode(F.array(*map(F.lit, versions)))).filter(F.col("batch_no") <= F.col("version"))
    scored = ensembles.predict(each.withColumn("model_version", F.format_string("v%d", "version")), models, FEATURE_COLUMNS, "row_no")
    return scored.select("version", "row_no", _r("prediction", 4).alias("prediction"))


@query("model_reload_scores", with_pipeline("SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differences FROM g"))
def model_reload_scores(spark, sf_dir):
    """A full pipeline saved (overwrite), loaded back and compared with the one in memory, row by row."""
    rows = frames.cleaned(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)  # cleaned once for the fit and the comparison
    try:
        model = training.fit_pipeline(rows, kind="gbt")
        path = scratch_path(spark, "reload") + "/fare_model_v1"
        model.write().overwrite().save(path)
        model.write().overwrite().save(path)
        scored = model.transform(rows)
        both = scored.select(*rows.columns, F.col("prediction").alias("kept"))
        again = PipelineModel.load(path).transform(both)
        found = again.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("prediction").eqNullSafe(F.col("kept"))).alias("n_differences")).first()
    finally:
        rows.unpersist()
    return spark.createDataFrame([tuple(found)], "n_rows BIGINT, n_differences BIGINT")


_VERSIONS_SQL = """
SELECT CAST(v.v AS INTEGER) AS version, CAST(v.v AS BIGINT) AS n_batches,
       CAST(count(*) AS BIGINT) AS n_rows, 'saved' AS status
FROM g JOIN range(1, 4) v(v) ON g.batch_no <= v.v
WHERE v.v <= (SELECT count(DISTINCT batch_no) FROM b)
GROUP BY v.v"""


@query("train_versions_summary", with_pipeline(_VERSIONS_SQL))
def train_versions_summary(spark, sf_dir):
    """Cumulative versions 1..3 trained and saved; rows and batches per version (M8)."""
    _, summary = frames.trained_models(spark, sf_dir)
    return summary.select("version", "n_batches", "n_rows", "status")


# --- files that break while they are read ---------------------------------------------------

def _files_with_a_cut_one(spark, sf_dir):
    """Flat gzip batch files of the accepted trips; the file of batch 2 is cut in the middle (stand-in for a broken upload)."""
    n = batching.fixture_batch_size(spark, sf_dir)
    base, whole = scratch_path(spark, "quarantine"), scratch_path(spark, "quarantine_whole")
    rows = frames.trips(spark, sf_dir)
    files.write_batches_flat(rows, whole, n, compression="gzip")
    for folder, is_dir in list_dir(spark, whole):
        for name, _ in list_dir(spark, f"{whole}/{folder}") if is_dir else []:
            if name.startswith("part-"):
                size = spark.read.format("binaryFile").load(f"{whole}/{folder}/{name}").select("length").first()[0]
                copy_head(spark, f"{whole}/{folder}/{name}", f"{base}/{folder}/{name}", size // 2 if folder == "file=batch_2.csv" else size)
    return base, n


@query("quarantine_files", with_pipeline(
    f"SELECT batch_no, CASE WHEN batch_no = 2 THEN 'truncated' END AS reason, CASE WHEN batch_no <> 2 THEN count(*) END AS n_rows FROM b GROUP BY batch_no"))
def quarantine_files(spark, sf_dir):
    """State of every batch file, one of them cut in the middle."""
    path, n = _files_with_a_cut_one(spark, sf_dir)
    states = quarantine.file_states(spark, path, n, schema=files.BATCH_FILE_SCHEMA)
    return states.select("batch_no", "reason", F.when(F.col("reason").isNull(), F.col("n_rows")).alias("n_rows"))


@query("train_with_quarantine", with_pipeline(
    "SELECT CAST(v.v AS INTEGER) AS version, CAST(count(DISTINCT batch_no) AS BIGINT) AS n_batches, count(*) AS n_rows, "
    "CASE WHEN v.v = 2 THEN 'skipped_unreadable' ELSE 'saved' END AS status FROM g JOIN range(1, 4) v(v) ON g.batch_no <= v.v AND g.batch_no <> 2 GROUP BY v.v"))
def train_with_quarantine(spark, sf_dir):
    """Three cumulative versions over files of which the second is cut: its version's number stays unused, the others are trained without it."""
    path, n = _files_with_a_cut_one(spark, sf_dir)
    states = quarantine.file_states(spark, path, n, schema=files.BATCH_FILE_SCHEMA).persist()  # a row a file
    lost = quarantine.quarantined(states)
    bad = {r.batch_no for r in lost.select("batch_no").collect()}
    rows = quarantine.sound_rows(quarantine.read_leniently(spark, path, files.BATCH_FILE_SCHEMA), lost)
    vb = versions.version_batches(quarantine.catalog(states), k=3, order="numeric")
    trained = training.train_versions(spark, features.training_rows(rows, keep=["batch_no"]), vb, scratch_path(spark, "quarantine_models"), kind="lr", unreadable=bad)
    return training.results_frame(spark, trained).select("version", "n_batches", "n_rows", "status")
