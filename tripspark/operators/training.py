"""Model pipelines and cumulative versioned training.

The feature stage is one multi-column ``Imputer`` (one aggregate for all nine
means instead of nine jobs) and a ``VectorAssembler`` that skips invalid rows;
the model is gradient-boosted trees (default) or linear regression. Version k
fits on the cleaned rows of the first k batches, read from one cached frame.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FEATURE_COLUMNS, LABEL

# Model settings of the original (GBT, 20 rounds; commented LR: 10 iterations, reg 0.1).
GBT_MAX_ITER = 20
LR_MAX_ITER = 10
LR_REG_PARAM = 0.1
DEFAULT_SEED = 42
MODEL_PREFIX = "fare_model_v"


def imputed_name(c: str) -> str:
    return f"{c}_imputed"


def feature_stages(input_cols: list[str] = FEATURE_COLUMNS, output_col: str = "features",
                   scale: bool = False, impute: bool = True) -> list:
    """Imputer (mean, NULL and NaN) → assembler (skip invalid) → optional scaler (M1-M4)."""
    stages = []
    cols = list(input_cols)
    if impute:
        out = [imputed_name(c) for c in cols]
        stages.append(Imputer(inputCols=cols, outputCols=out, strategy="mean"))
        cols = out
    assembled = "features_unscaled" if scale else output_col
    stages.append(VectorAssembler(inputCols=cols, outputCol=assembled, handleInvalid="skip"))
    if scale:
        stages.append(StandardScaler(inputCol=assembled, outputCol=output_col, withMean=True, withStd=True))
    return stages


def feature_pipeline(input_cols: list[str] = FEATURE_COLUMNS, output_col: str = "features",
                     scale: bool = False) -> Pipeline:
    return Pipeline(stages=feature_stages(input_cols, output_col, scale))


def regressor(kind: str = "gbt", seed: int = DEFAULT_SEED, **params):
    """``gbt`` (default of the code), ``lr`` (commented variant) or ``lr_plain`` (docs)."""
    if kind == "gbt":
        return GBTRegressor(featuresCol="features", labelCol=LABEL, seed=seed,
                            **{"maxIter": GBT_MAX_ITER, **params})
    if kind == "lr":
        return LinearRegression(featuresCol="features", labelCol=LABEL,
                                **{"maxIter": LR_MAX_ITER, "regParam": LR_REG_PARAM, **params})
    if kind == "lr_plain":
        return LinearRegression(featuresCol="features", labelCol=LABEL, **params)
    raise ValueError(f"unknown model kind {kind!r}")


def full_pipeline(kind: str = "gbt", input_cols: list[str] = FEATURE_COLUMNS, scale: bool = False,
                  seed: int = DEFAULT_SEED, **params) -> Pipeline:
    """Nested pipeline: feature pipeline, then the regressor (M7)."""
    return Pipeline(stages=[feature_pipeline(input_cols, "features", scale), regressor(kind, seed, **params)])


def fit_pipeline(train: DataFrame, kind: str = "gbt", input_cols: list[str] = FEATURE_COLUMNS,
                 scale: bool = False, seed: int = DEFAULT_SEED, **params) -> PipelineModel:
    """Fit the full pipeline. The training rows are read once and kept for the
    several passes of the fit (imputer means, split finding, boosting rounds)
    unless the caller already persisted them."""
    if train.storageLevel.useMemory or train.storageLevel.useDisk:
        return full_pipeline(kind, input_cols, scale, seed, **params).fit(train)
    data = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return full_pipeline(kind, input_cols, scale, seed, **params).fit(data)
    finally:
        data.unpersist()


def model_path(models_dir: str, version: int) -> str:
    return f"{models_dir.rstrip('/')}/{MODEL_PREFIX}{version}"


@dataclass
class VersionResult:
    version: int
    n_batches: int
    n_rows: int
    status: str
    path: str | None
    error: str | None = None


def train_versions(spark: SparkSession, cleaned: DataFrame, vb: DataFrame, models_dir: str,
                   kind: str = "gbt", seed: int = DEFAULT_SEED, overwrite: bool = True,
                   parallelism: int = 3, input_cols: list[str] = FEATURE_COLUMNS,
                   unreadable: frozenset[int] | set[int] = frozenset(), **params) -> list[VersionResult]:
    """Fit and save one pipeline per version (M8).

    ``cleaned`` has ``batch_no`` and the training columns; ``vb`` maps versions to
    batches (``operators.versions.version_batches``). Versions are cumulative, so one copy of
    the rows of all their batches is cached, with the first version each batch belongs to;
    fit v takes the rows up to v. The batch numbers are a literal filter that prunes the scan.
    Batches in ``unreadable`` are left out, and the version that would add one is not trained:
    its number stays unused (S9). An empty training set is
    skipped (N8) and a failing version does not stop the others; if the shared read of the rows fails, each version
    reads its own batches, so one broken file fails only the versions that hold it. Versions are
    independent, so up to ``parallelism`` fits run as concurrent Spark jobs
    (the same pattern as ``CrossValidator(parallelism=...)``).
    """
    train_cols = [LABEL, *FEATURE_COLUMNS]
    # the version table is bounded by k(k+1)/2 rows
    first: dict[int, int] = {}
    for r in vb.collect():
        first[r["batch_no"]] = min(r["version"], first.get(r["batch_no"], r["version"]))
    expected = sorted({*first.values()})
    used = {b: v for b, v in first.items() if b not in unreadable}
    lost = {first[b] for b in first if b in unreadable}
    added = F.coalesce(*[F.when(F.col("batch_no") == b, F.lit(v)) for b, v in sorted(used.items())], F.lit(None).cast("int"))
    rows = (cleaned.filter(F.col("batch_no").isin(sorted(used))).select(added.alias("version"), "batch_no", *train_cols)
            .persist(StorageLevel.MEMORY_AND_DISK))
    def counted(df: DataFrame) -> dict[int, tuple[int, int]]:
        return {r["version"]: (r["n_rows"], r["n_batches"]) for r in df.groupBy("version").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct("batch_no").alias("n_batches")).collect()}

    try:
        try:
            shared = counted(rows)
        except Exception:  # noqa: BLE001 - a file broke while it was read: versions that don't need it are still trained
            rows.unpersist()
            rows, shared = rows.select("*"), None

        def fit_one(v: int) -> VersionResult:
            path = model_path(models_dir, v)
            n_rows = n_batches = 0
            try:
                # without a shared read, the version's own batches (a literal filter, so no other file is opened)
                own = rows if shared is not None else rows.filter(F.col("batch_no").isin([b for b, w in used.items() if w <= v]))
                each = shared if shared is not None else counted(own)
                n_rows, n_batches = (sum(x[i] for w, x in each.items() if w <= v) for i in (0, 1))
                if v in lost:
                    return VersionResult(v, n_batches, n_rows, "skipped_unreadable", None)
                if n_rows == 0:
                    return VersionResult(v, n_batches, 0, "skipped_empty", None)
                model = full_pipeline(kind, input_cols, False, seed, **params).fit(own.filter(F.col("version") <= v).select(*train_cols))
                w = model.write()
                (w.overwrite() if overwrite else w).save(path)
                return VersionResult(v, n_batches, n_rows, "saved", path)
            except Exception as e:  # noqa: BLE001 - one failed version must not stop the rest
                return VersionResult(v, n_batches, n_rows, "failed", path, str(e))

        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(expected) or 1))) as pool:
            return list(pool.map(fit_one, expected))
    finally:
        rows.unpersist()


def results_frame(spark: SparkSession, results: list[VersionResult]) -> DataFrame:
    """Training summary as a DataFrame (one row per version)."""
    schema = "version INT, n_batches BIGINT, n_rows BIGINT, status STRING, path STRING, error STRING"
    return spark.createDataFrame([(r.version, r.n_batches, r.n_rows, r.status, r.path, r.error)
                                  for r in results], schema)
