"""Models as data: node tables, expressions, packed scoring, sufficient statistics."""
import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from tripspark.operators import ensembles, gram, training

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(5)
    rows = [(float(r.normal()), float(r.integers(0, 4)), int(r.integers(0, 9)), i % 3 + 1, i) for i in range(400)]
    rows = [(a, b, c, 3 * a + b * b - c + float(r.normal(0, 0.1)), v, i) for a, b, c, v, i in rows]
    return spark.createDataFrame(rows, "a double, b double, c int, fare_amount double, v int, id long").persist()


def _saved(model, base, v):
    path = f"{base}/fare_model_v{v}"
    model.write().overwrite().save(path)
    return path


@pytest.mark.parametrize("kind", ["gbt", "forest", "tree"])
def test_expression_and_packed_equal_transform(spark, data, tmp_out, kind):
    model = {"gbt": training.regressor("gbt", maxIter=4, maxDepth=3), "forest": RandomForestRegressor(labelCol="fare_amount", numTrees=3, seed=1),
             "tree": DecisionTreeRegressor(labelCol="fare_amount", maxDepth=4)}[kind]
    fitted = Pipeline(stages=[training.feature_pipeline(COLS), model]).fit(data)
    path = _saved(fitted, tmp_out, 1)
    want = {r.id: r.prediction for r in fitted.transform(data).select("id", "prediction").collect()}
    nodes = ensembles.node_table(spark, [path])
    e = ensembles.tree_expression(nodes, [F.col(c).cast("double") for c in COLS])
    packed = ensembles.predict(data.withColumn("model_version", F.lit("v1")), ensembles.packed_models(spark, [path]), COLS, "id")
    for got in (data.select("id", e.alias("p")), packed.select("id", F.col("prediction").alias("p"))):
        assert all(abs(r.p - want[r.id]) < 1e-9 for r in got.collect())


def test_versions_are_data(spark, data, tmp_out, monkeypatch):
    """Same operators for one version and for thirty, each row by its own version; missing inputs take the version's means; salted join beyond the limit."""
    paths, models = [], {}
    for v in range(1, 4):
        m = Pipeline(stages=[training.feature_pipeline(COLS), training.regressor("gbt", maxIter=2, maxDepth=2)]).fit(data.filter(F.col("v") <= v))
        paths.append(_saved(m, tmp_out, v))
        models[f"v{v}"] = m
    holes = data.withColumn("a", F.when(F.col("id") % 5 == 0, None).otherwise(F.col("a"))).withColumn("b", F.when(F.col("id") % 7 == 0, float("nan")).otherwise(F.col("b")))
    holes = holes.withColumn("c", F.when(F.col("id") % 11 == 0, None).otherwise(F.col("c")))
    asked = holes.withColumn("model_version", F.when(F.col("id") % 13 == 0, "v9").otherwise(F.format_string("v%d", "v")))
    packed = ensembles.packed_models(spark, paths)
    want = {}
    for v, m in models.items():
        want.update({r.id: r.prediction for r in m.transform(asked.filter(F.col("model_version") == v)).select("id", "prediction").collect()})
    for limit in (ensembles.MAX_BROADCAST_ELEMENTS, 0):
        monkeypatch.setattr(ensembles, "MAX_BROADCAST_ELEMENTS", limit)
        got = {r.id: r.prediction for r in ensembles.predict(asked, packed, COLS, "id").collect()}
        assert len(got) == 400 and all(got[i] is None if i % 13 == 0 else abs(got[i] - want[i]) < 1e-9 for i in got)

    def operators(models):
        plan = ensembles.predict(asked, models, COLS, "id")._jdf.queryExecution().optimizedPlan().toString()
        return [line.strip(" +-:").split(" ")[0] for line in plan.splitlines()]
    monkeypatch.undo()
    many = packed.withColumn("model_version", F.explode(F.array(*[F.concat("model_version", F.lit(f"_{k}")) for k in range(10)])))
    kept = f"{tmp_out}/many"
    many.write.parquet(kept)
    packed.write.parquet(f"{tmp_out}/few")
    assert operators(spark.read.parquet(kept)) == operators(spark.read.parquet(f"{tmp_out}/few"))


def test_unsupported_and_missing(spark, data, tmp_out):
    scaled = Pipeline(stages=[VectorAssembler(inputCols=COLS, outputCol="x"), StandardScaler(inputCol="x", outputCol="features"), LinearRegression(labelCol="fare_amount")]).fit(data)
    with pytest.raises(ensembles.UnsupportedModel):
        ensembles.packed_models(spark, [_saved(scaled, tmp_out, 7)])
    plain = Pipeline(stages=[VectorAssembler(inputCols=COLS, outputCol="features", handleInvalid="skip"), LinearRegression(labelCol="fare_amount")]).fit(data)
    packed = ensembles.packed_models(spark, [_saved(plain, tmp_out, 8)])
    rows = data.withColumn("a", F.when(F.col("id") > 5, F.col("a"))).withColumn("model_version", F.lit("v8"))
    want = {r.id: r.prediction for r in plain.transform(rows.filter("a is not null")).collect()}
    got = {r.id: r.prediction for r in ensembles.predict(rows, packed, COLS, "id").collect()}
    assert all(abs(got[i] - want[i]) < 1e-9 if i in want else got[i] is None for i in got) and len(got) == 400


@pytest.mark.parametrize("reg", [0.0, 0.1, 2.0])
def test_gram_equals_linear_regression(data, reg):
    v = VectorAssembler(inputCols=COLS, outputCol="features").transform(data)
    m = LinearRegression(labelCol="fare_amount", regParam=reg, solver="normal").fit(v)
    coef, intercept, n = gram.fit(data, COLS, reg=reg)
    assert n == 400 and np.allclose(coef, m.coefficients.toArray(), atol=1e-8) and abs(intercept - m.intercept) < 1e-8


def test_gram_versions_and_edges(spark, data):
    got = {r.v: r for r in gram.fit_versions(data, COLS, by="v").collect()}
    for v in (1, 2, 3):
        coef, intercept, n = gram.fit(data.filter(F.col("v") <= v), COLS)
        assert got[v].n == n and np.allclose(got[v].coefficients, coef) and abs(got[v].intercept - intercept) < 1e-8
    whole = gram.merged(gram.statistics(data, COLS, by=["v"])).first()
    assert whole.n == 400 and np.allclose(gram.solve(whole.n, whole.center, whole.sums, whole.products)[0], gram.fit(data, COLS)[0])
    odd = data.withColumn("k", F.lit(4.0)).withColumn("b", F.when(F.col("id") % 2 == 0, F.col("b")).otherwise(float("nan")))
    coef, _, n = gram.fit(odd, ["a", "b", "k"])
    assert n == 200 and coef[2] == 0
    with pytest.raises(ValueError):
        gram.fit(data.filter("false"), COLS)


def test_trees_are_walked_in_batches(spark, data, tmp_out):
    """Trees up to the broadcast limit are walked as arrays, not row by row; versions without trees, unknown ones and holes beside them; as by the joined model."""
    tree = Pipeline(stages=[training.feature_pipeline(COLS), training.regressor("gbt", maxIter=2, maxDepth=2)]).fit(data)
    bare = Pipeline(stages=[VectorAssembler(inputCols=COLS, outputCol="features", handleInvalid="skip"), training.regressor("gbt", maxIter=2, maxDepth=2)]).fit(data)
    line = Pipeline(stages=[training.feature_pipeline(COLS), LinearRegression(labelCol="fare_amount")]).fit(data)
    packed = ensembles.packed_models(spark, [_saved(m, tmp_out, v) for v, m in enumerate((tree, bare, line), 1)])
    rows = data.withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a"))).withColumn("model_version", F.when(F.col("id") % 7 > 0, F.format_string("v%d", F.col("id") % 4 + 1)))
    got = ensembles.predict(rows, packed, COLS, "id")
    assert "EvalPython" in got._jdf.queryExecution().executedPlan().toString()
    one = packed.select("model_version", F.struct(*[c for c in packed.columns if c != "model_version"]).alias("_model"))
    want = {r.id: r.prediction for r in ensembles.with_prediction(rows.join(one, "model_version", "left"), COLS).collect()}
    assert {r.id: r.prediction for r in got.collect()} == want and len(want) == 400 and sum(v is None for v in want.values()) > 0


def test_linear_models_are_scored_in_batches(spark):
    """Linear parts are summed a batch of rows at a time, not row by row; holes, unknown versions, NaN and missing coefficients as by the joined model."""
    models = spark.createDataFrame([("v1", [("a", 1.5), ("c", 2.7)], 0.25, [2.0, -3.0], 1, None, None, None, None, None, None), ("v2", [("b", None), ("x", 4.0)], 1.0, [0.1], 1, None, None, None, None, None, None),
                                    ("v3", [], 7.0, [], 1, None, None, None, None, None, None), ("v4", None, 7.0, [], 1, None, None, None, None, None, None)],
                                   "model_version string, inputs array<struct<name: string, mean: double>>, intercept double, coefficients array<double>, depth int, feature array<int>, "
                                   "threshold array<double>, left array<int>, right array<int>, value array<double>, roots array<struct<place: int, weight: double>>")
    values = [(0.1, 0.2, 3), (None, None, None), (float("nan"), float("nan"), 1), (float("inf"), -0.3, 2)]
    rows = spark.createDataFrame([(a, b, c, v, i) for i, (a, b, c) in enumerate(values) for v in ("v1", "v2", "v3", "v4", "v9", None)], "a double, b double, c int, model_version string, id long")
    got = ensembles.predict(rows, models, COLS, "id")
    assert "ArrowEvalPython" in got._jdf.queryExecution().executedPlan().toString()
    one = models.select("model_version", F.struct(*[c for c in models.columns if c != "model_version"]).alias("_model"))
    want = ensembles.with_prediction(rows.join(one, "model_version", "left"), COLS)
    assert sorted(map(str, want.select("id", "model_version", "prediction").collect())) == sorted(map(str, got.select("id", "model_version", "prediction").collect()))


def test_inputs_that_no_model_takes_are_not_sent(spark, data, tmp_out):
    """Only the columns that some version takes go to the batches of rows, with the same predictions."""
    fits = [(1, ["a"]), (2, ["c", "a"])]
    models = [(v, Pipeline(stages=[training.feature_pipeline(c), LinearRegression(labelCol="fare_amount")]).fit(data)) for v, c in fits]
    packed = ensembles.packed_models(spark, [_saved(m, tmp_out, v) for v, m in models])
    rows = data.withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a"))).withColumn("model_version", F.format_string("v%d", "v"))
    got = ensembles.predict(rows, packed, COLS, "id")
    plan = got.select("prediction")._jdf.queryExecution().optimizedPlan().toString()
    sent = plan.split("predictions(")[1].split(")#")[0]
    assert "a#" in sent and "c#" in sent and "b#" not in sent
    one = packed.select("model_version", F.struct(*[c for c in packed.columns if c != "model_version"]).alias("_model"))
    want = {r.id: r.prediction for r in ensembles.with_prediction(rows.join(one, "model_version", "left"), COLS).collect()}
    assert {r.id: r.prediction for r in got.collect()} == want and sum(v is not None for v in want.values()) > 200
    none = ensembles.predict(rows, packed.filter("false"), COLS, "id")
    assert none.filter("prediction is not null").count() == 0 and none.count() == 400
