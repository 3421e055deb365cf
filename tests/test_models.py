"""Training, saving, loading and the registry."""

import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tripspark.operators import training, versions
from tripspark.plans import frames
from tripspark.sources import files
from tripspark.sources import models as registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lr_versions(spark):
    from tripspark.session import scratch_path

    out = scratch_path(spark, "models_test")
    vb = versions.version_batches(frames.catalog(spark, SF), 3, "numeric")
    res = training.train_versions(spark, frames.cleaned(spark, SF, batch=True), vb, out, kind="lr")
    return out, res


def test_versions_trained_and_saved(lr_versions):
    out, res = lr_versions
    assert [(r.version, r.n_batches, r.n_rows, r.status) for r in res] == [
        (1, 1, 53, "saved"), (2, 2, 100, "saved"), (3, 3, 154, "saved")]


def test_imputer_int_columns_truncate(spark, lr_versions):
    out, _ = lr_versions
    model = PipelineModel.load(training.model_path(out, 3))
    imputer = model.stages[0].stages[0]
    row = spark.createDataFrame([(None,) * 9], ", ".join(f"{c} {'INT' if c in ('passenger_count', 'hour', 'day_of_week', 'month') else 'DOUBLE'}"
                                                        for c in training.FEATURE_COLUMNS))
    got = imputer.transform(row).first()
    means = imputer.surrogateDF.first()
    assert got["passenger_count_imputed"] == int(means["passenger_count"])
    assert got["hour_imputed"] == int(means["hour"])
    assert got["distance_km_imputed"] == pytest.approx(means["distance_km"])


def test_reload_equals_in_memory(spark, lr_versions):
    out, _ = lr_versions
    data = frames.cleaned(spark, SF)
    fitted = training.fit_pipeline(data, kind="lr")
    path = out + "/roundtrip"
    fitted.write().overwrite().save(path)
    a = fitted.transform(data).select("row_no", F.col("prediction").alias("a"))
    b = PipelineModel.load(path).transform(data).select("row_no", F.col("prediction").alias("b"))
    assert a.join(b, "row_no").filter(F.abs(F.col("a") - F.col("b")) > 1e-12).count() == 0


def test_save_without_overwrite_fails(spark, lr_versions):
    out, _ = lr_versions
    model = PipelineModel.load(training.model_path(out, 1))
    with pytest.raises(Exception):
        model.save(training.model_path(out, 1))


def test_empty_training_set_is_skipped(spark, lr_versions):
    out, _ = lr_versions
    empty = frames.cleaned(spark, SF, batch=True).filter(F.lit(False))
    vb = spark.createDataFrame([(1, 1)], "version INT, batch_no INT")
    res = training.train_versions(spark, empty, vb, out + "/empty", kind="lr")
    assert [(r.version, r.status) for r in res] == [(1, "skipped_empty")]


def test_failed_version_does_not_stop_the_rest(spark, lr_versions):
    out, _ = lr_versions
    data = frames.cleaned(spark, SF, batch=True)
    vb = versions.version_batches(frames.catalog(spark, SF), 2, "numeric")
    # maxIter=-1 is rejected when fitting: every version fails, and each is reported
    res = training.train_versions(spark, data, vb, out + "/bad", kind="lr", maxIter=-1)
    assert [r.status for r in res] == ["failed", "failed"] and all(r.error for r in res)


def test_unreadable_batch_leaves_its_number_unused(spark, lr_versions):
    out, _ = lr_versions
    data = frames.cleaned(spark, SF, batch=True)
    vb = versions.version_batches(frames.catalog(spark, SF), 3, "numeric")
    res = training.train_versions(spark, data, vb, out + "/lost", kind="lr", unreadable={2})
    assert [(r.version, r.n_batches, r.status) for r in res] == [(1, 1, "saved"), (2, 1, "skipped_unreadable"), (3, 2, "saved")]
    src = frames.ingest_batches(spark, SF)
    assert files.unreadable_batches(spark, src, [1, 2, 99]) == {99}


def test_training_scan_is_pruned_to_the_versions_batches(spark, lr_versions):
    data = frames.cleaned(spark, SF, batch=True).filter(F.col("batch_no").isin([1, 2, 3]))
    plan = data._jdf.queryExecution().executedPlan().toString()
    assert "batch_no" in plan.split("PartitionFilters:")[1].split("]")[0] and " IN (1,2,3)" in plan


def test_versions_that_share_a_name_give_one_row(spark, lr_versions):
    out, _ = lr_versions
    model = PipelineModel.load(training.model_path(out, 1))
    for name in ("fare_model_v1", "fare_model_x_v1"):
        model.write().overwrite().save(f"{out}/twice/{name}")
    reg, models = registry.scan_models(spark, out + "/twice")
    assert [(r.model_name, r.model_version) for r in reg.collect()] == [("fare_model_x_v1", "v1")] and list(models) == ["v1"]


def test_failed_training_is_not_kept(spark, monkeypatch):
    calls = []

    def failing(spark, cleaned, vb, models_dir, **kw):
        calls.append(1)
        return [training.VersionResult(1, 1, 5, "failed", None, "x" * 2000)]
    monkeypatch.setattr(training, "train_versions", failing)
    for _ in range(2):
        _, summary = frames.trained_models(spark, SF, k=2, kind="lr")
        assert [(r.status, len(r.error)) for r in summary.collect()] == [("failed", 2000)]
    assert len(calls) == 2


def test_registry_expected_and_scan(spark, lr_versions):
    out, _ = lr_versions
    local = out.replace("file:", "")
    os.makedirs(os.path.join(local, "fare_model_broken"), exist_ok=True)
    os.makedirs(os.path.join(local, "other_folder"), exist_ok=True)
    reg, models = registry.load_expected(spark, out, 4)
    rows = {r.model_version: (r.present, r.loaded) for r in reg.collect()}
    assert rows == {"v1": (True, True), "v2": (True, True), "v3": (True, True), "v4": (False, False)}
    assert sorted(models) == ["v1", "v2", "v3"]
    scan, smodels = registry.scan_models(spark, out)
    found = {r.model_name: (r.model_version, r.loaded) for r in scan.collect()}
    assert found["fare_model_broken"] == ("broken", False) and "other_folder" not in found
    assert sorted(smodels) == ["v1", "v2", "v3"]
    s = registry.registry_summary(scan).first()
    assert (s.loaded_models, s.available_models) == (3, "v1,v2,v3")


def test_gbt_reload_and_rerun_agree(spark, lr_versions):
    out, _ = lr_versions
    data = frames.cleaned(spark, SF).repartition(4, "row_no")
    a = training.fit_pipeline(data, kind="gbt", maxIter=3)
    b = training.fit_pipeline(data, kind="gbt", maxIter=3)
    a.write().overwrite().save(out + "/gbt")
    c = PipelineModel.load(out + "/gbt")
    pa = a.transform(data).select("row_no", F.col("prediction").alias("a"))
    pb = b.transform(data).select("row_no", F.col("prediction").alias("b"))
    pc = c.transform(data).select("row_no", F.col("prediction").alias("c"))
    j = pa.join(pb, "row_no").join(pc, "row_no")
    assert j.filter((F.abs(F.col("a") - F.col("b")) > 1e-9) | (F.abs(F.col("a") - F.col("c")) > 1e-9)).count() == 0
    assert j.count() == 639


def test_registry_of_missing_folder_is_empty(spark, tmp_out):
    reg, models = registry.scan_models(spark, tmp_out + "/no_models_here")
    assert reg.count() == 0 and models == {}
    s = registry.registry_summary(reg).first()
    assert s.loaded_models == 0


def test_reload_comparison_cleans_each_row_once(spark, monkeypatch):
    """``model_reload_scores`` keeps its rows for the fit and the comparison."""
    from pyspark.sql import functions as F
    from tripspark.plans import frames, q_models
    from tripspark.schemas import FEATURE_COLUMNS

    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def fare(i):
        seen.add(1)
        return float(i % 7)

    rows = spark.range(40).select(fare("id").alias("fare_amount"), *[((F.col("id") * (k + 3)) % 11).cast("double").alias(c) for k, c in enumerate(FEATURE_COLUMNS)])
    fit = training.fit_pipeline
    monkeypatch.setattr(frames, "cleaned", lambda spark, sf_dir: rows)
    monkeypatch.setattr(training, "fit_pipeline", lambda train, kind: fit(train, kind="lr"))
    assert tuple(q_models.model_reload_scores(spark, "").first()) == (40, 0)
    assert seen.value == 40
