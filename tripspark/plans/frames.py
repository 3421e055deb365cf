"""Lazy building blocks shared by the registered queries.

The data flow is the original's, with Spark jobs for every stage:

    raw trip CSV ──type/validate──▶ accepted trips ──batch──▶ batch CSV files ──▶ features ──▶ models

``raw`` and ``sent`` are computed from the raw CSV in the query's own plan.
``trips`` reads the batch files, which are written once per input by the
ingest job (``ingest_batches``) into the shared scratch folder, exactly as the
trainer of the original reads the consumer's batch files.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from .. import fixture
from ..operators import batching, features, ingest, training, versions
from ..schemas import FEATURE_COLUMNS
from ..session import materialize, path_exists, shared_dir
from ..sources import files

REQUEST_TABLE = "request_id BIGINT, value STRING, model_version STRING"


def raw(spark: SparkSession, sf_dir: str, with_key: bool = True) -> DataFrame:
    return fixture.load_raw_trips(spark, sf_dir, with_key=with_key)


def plain_csv(spark: SparkSession, sf_dir: str) -> str:
    """The raw source without its position column: header CSV of the eight trip columns, written once per input."""
    src = fixture.raw_source_path(spark, sf_dir)
    return materialize(spark, f"{shared_dir(spark)}/tripspark/plain/{fixture.table_tag(src, 'plain')}",
                       lambda p: fixture.write_plain_csv(spark, sf_dir, p))


def typed(spark: SparkSession, sf_dir: str, key_mode: str = "null") -> DataFrame:
    return ingest.type_trips(raw(spark, sf_dir), key_mode=key_mode)


def sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.valid_trips(raw(spark, sf_dir), key_mode="null")


def batched(spark: SparkSession, sf_dir: str, batch_size: int | None = None) -> DataFrame:
    """Accepted trips with ``batch_no``, computed in-plan (distributed dense index)."""
    n = batch_size or batching.fixture_batch_size(spark, sf_dir)
    return batching.assign_batches(sent(spark, sf_dir), n)


def ingest_batches(spark: SparkSession, sf_dir: str, out: str | None = None,
                   batch_size: int | None = None) -> str:
    """Ingest job: raw CSV → typed, validated → numbered batches → batch CSV files.

    Without ``out`` the files go to a folder keyed by the raw source and batch
    size and are reused if complete.
    """
    n = batch_size or batching.fixture_batch_size(spark, sf_dir)

    def write(path: str) -> None:
        rows = sent(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)  # parsed once for bounds, counts and ranks
        try:
            files.write_batches_csv(batching.assign_batches(rows, n), path)
        finally:
            rows.unpersist()

    if out is not None:
        write(out)
        return out
    src = fixture.raw_source_path(spark, sf_dir)
    return materialize(spark, f"{shared_dir(spark)}/tripspark/batches/{fixture.table_tag(src, n)}", write)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed accepted trips with ``row_no`` and ``batch_no``, scanned from the batch files."""
    return files.read_batches_csv(spark, ingest_batches(spark, sf_dir))


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.add_features(trips(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str, batch: bool = False) -> DataFrame:
    keep = ["row_no", "batch_no"] if batch else ["row_no"]
    return features.training_rows(trips(spark, sf_dir), keep=keep)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = batching.fixture_batch_size(spark, sf_dir)
    return versions.batch_catalog(spark, ingest_batches(spark, sf_dir), n)


def trained_models(spark: SparkSession, sf_dir: str, k: int = 3, order: str = "numeric",
                   kind: str = "gbt", input_cols: list[str] = FEATURE_COLUMNS) -> tuple[str, DataFrame]:
    """Training job: fit and save versions 1..k once per input; returns (models_dir, summary).

    The summary (one row per version) is stored next to the models in ``_versions``.
    """
    src = ingest_batches(spark, sf_dir)
    tag = fixture.table_tag(src, k, order, kind, *input_cols)
    models_dir = f"{shared_dir(spark)}/tripspark/models/{tag}"

    summary_path = f"{models_dir}/_versions"
    if not path_exists(spark, f"{summary_path}/_SUCCESS"):
        vb = versions.version_batches(catalog(spark, sf_dir), k=k, order=order)
        lost = files.unreadable_batches(spark, src, sorted({r["batch_no"] for r in vb.collect()}))
        results = training.train_versions(spark, cleaned(spark, sf_dir, batch=True), vb, models_dir, kind=kind,
                                          input_cols=input_cols, unreadable=lost)
        summary = training.results_frame(spark, results)
        if any(r.status == "failed" for r in results):
            return models_dir, summary  # not kept: the next call trains again
        summary.write.mode("overwrite").parquet(summary_path)
    return models_dir, spark.read.parquet(summary_path)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests derived from the accepted trips (FIXTURES.md).

    Written once per input as a parquet table (the scoring input a service would
    read), partitioned by ``model_version``: each version's scoring branch reads its own files.
    """
    src = fixture.raw_source_path(spark, sf_dir)
    tag = fixture.table_tag(src, "requests")
    path = materialize(spark, f"{shared_dir(spark)}/tripspark/requests/{tag}",
                       lambda p: fixture.requests_from_trips(sent(spark, sf_dir))
                       .write.mode("overwrite").partitionBy("model_version").parquet(p))
    return spark.read.schema(REQUEST_TABLE).parquet(path).select("request_id", "model_version", "value")
