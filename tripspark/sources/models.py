"""Model registry: find, load and describe saved pipeline versions.

The registry is a DataFrame with one row per model version plus a driver-side map
``version → PipelineModel`` used for scoring: every row of it stands for a model the driver looked at.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.training import MODEL_PREFIX, model_path
from ..session import file_signature, list_dir, path_exists

REGISTRY_SCHEMA = ("model_name STRING, model_version STRING, path STRING, present BOOLEAN, "
                   "loaded BOOLEAN, error STRING")
FOLDER_PREFIX = "fare_model_"


# The loaded model of each path with the identity of its metadata files: a model folder
# is loaded once per driver and again only when it was rewritten.
_LOADED: dict[str, tuple[str, object]] = {}


def _identity(spark: SparkSession, path: str) -> str:
    """Names, lengths and times of the metadata files (a folder's own time need not change)."""
    files = sorted(n for n, is_dir in list_dir(spark, f"{path}/metadata") if not is_dir and n.startswith("part-"))
    return ",".join(f"{n}:{file_signature(spark, f'{path}/metadata/{n}')}" for n in files)


def _try_load(path: str, loader=PipelineModel, spark: SparkSession | None = None):
    try:
        key = _identity(spark, path) if spark is not None else None
        if key and _LOADED.get(path, ("",))[0] == key:
            return _LOADED[path][1], None
        model = loader.load(path)
        if key:
            _LOADED[path] = (key, model)
        return model, None
    except Exception as e:  # noqa: BLE001 - a broken model is reported, not fatal
        return None, str(e)


def load_expected(spark: SparkSession, models_dir: str, n_expected: int = 3):
    """Fixed names ``fare_model_v1..n`` with an existence test.

    Returns ``(registry DataFrame, {"v1": model, ...})``; versions are keyed
    ``v<i>`` like the request route.
    """
    rows, models = [], {}
    for i in range(1, n_expected + 1):
        name, path = f"{MODEL_PREFIX}{i}", model_path(models_dir, i)
        present = path_exists(spark, path)
        model, err = _try_load(path, spark=spark) if present else (None, "not found")
        if model is not None:
            models[f"v{i}"] = model
        rows.append((name, f"v{i}", path, present, model is not None, err))
    return spark.createDataFrame(rows, REGISTRY_SCHEMA), models


def scan_models(spark: SparkSession, models_dir: str):
    """Every folder named ``fare_model_*``; version = text after the last ``_``.

    Folders that share a version give one row: the last by name that loads, as in the original's map.
    """
    rows: dict[str, tuple] = {}
    models: dict[str, PipelineModel] = {}
    for name, is_dir in sorted(list_dir(spark, models_dir)):
        if not (is_dir and name.startswith(FOLDER_PREFIX)):
            continue
        version = name.split("_")[-1]
        path = f"{models_dir.rstrip('/')}/{name}"
        model, err = _try_load(path, spark=spark)
        if model is not None:
            models[version] = model
        if model is not None or version not in rows:
            rows[version] = (name, version, path, True, model is not None, err)
    return spark.createDataFrame(list(rows.values()), REGISTRY_SCHEMA), models


def loaded_versions(registry: DataFrame) -> DataFrame:
    """Loaded versions, each once."""
    return registry.filter("loaded").select("model_version", "model_name").dropDuplicates(["model_version"])


def registry_summary(registry: DataFrame) -> DataFrame:
    """Loaded-model count and sorted version list (A5: /models, /health, /status)."""
    loaded = registry.filter("loaded")
    return loaded.agg(F.count(F.lit(1)).alias("loaded_models"),
                      F.array_join(F.sort_array(F.collect_list("model_version")), ",").alias("available_models"))


def load_linear_model(path: str) -> LinearRegressionModel:
    """Plain linear model of the docs variant."""
    return LinearRegressionModel.load(path)
