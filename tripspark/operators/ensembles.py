"""Fitted models as data: node tables, a native expression, and one scoring pass for any number of versions.

A saved pipeline is a folder of small tables. ``node_table`` reads the trees of any number of saved pipelines in one scan as rows
(model_version, tree, weight, node, feature, threshold, left, right, value). ``tree_expression`` compiles one model's rows to a
column expression. ``packed_models`` gathers each version into one row of arrays (tree nodes, linear coefficients, input names and
imputed means), and ``predict`` scores batches of requests with the arrays of their versions (a large table is joined instead): the version is
data, so the plan has the same operators for 3 versions and for 300.

Inputs are as in training: a missing (NULL or NaN) input takes its version's mean, cut to whole numbers where the column holds them. Without
a mean (pipelines that don't impute) the row has no prediction.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import list_dir
from .training import MODEL_PREFIX

NODE_SCHEMA = ("model_version STRING, tree INT, weight DOUBLE, node INT, feature INT, threshold DOUBLE, left INT, right INT, value DOUBLE")
#: Array elements of all packed models that are broadcast; a larger table is joined by shuffle, spread by salts.
MAX_BROADCAST_ELEMENTS = 4_000_000
SALTS = 16

_TREES = {"GBTRegressionModel", "RandomForestRegressionModel", "DecisionTreeRegressionModel"}
_WHOLE = (T.IntegerType, T.LongType, T.ShortType, T.ByteType)


class UnsupportedModel(ValueError):
    """A stage that cannot be packed."""


def saved_stages(spark: SparkSession, path: str) -> list[tuple[str, str, dict]]:
    """(class name, folder, parameters) of a saved pipeline's stages in order, nested pipelines opened."""
    meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    kind = meta["class"].rsplit(".", 1)[-1]
    if kind != "PipelineModel":
        return [(kind, path, {**meta.get("defaultParamMap", {}), **meta["paramMap"]})]
    folders = sorted((n for n, is_dir in list_dir(spark, f"{path}/stages") if is_dir), key=lambda n: int(n.split("_", 1)[0]))
    return [s for n in folders for s in saved_stages(spark, f"{path}/stages/{n}")]


def version_of(path: str) -> str:
    """``v<n>`` of a model folder ``fare_model_v<n>``: the text after the last ``_`` of its name."""
    return path.rstrip("/").rsplit("/", 1)[-1].rsplit("_", 1)[-1]


def _by_version(df: DataFrame, folders: dict[str, str]) -> DataFrame:
    """``df`` with the version whose folder its file lies in."""
    file = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]*)/stages/", 1)
    return df.withColumn("model_version", F.element_at(F.split(file, "_"), -1)).filter(F.col("model_version").isin(sorted(folders)))


def node_table(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The nodes of the trees of saved pipelines: one scan, whatever their number.

    ``feature`` is -1 and ``left``, ``right`` are NULL for a leaf; a row goes left if its feature is at most ``threshold``. Trees of a forest
    have weight 1 / their number, a single tree has weight 1.
    """
    found = {version_of(p): [s for s in saved_stages(spark, p) if s[0] in _TREES] for p in paths}
    if any(len(s) != 1 for s in found.values()):
        raise UnsupportedModel(f"not one tree model: {sorted(v for v, s in found.items() if len(s) != 1)}")
    kinds = {v: s[0][0] for v, s in found.items()}
    parts = []
    for single in (False, True):
        folders = {v: s[0][1] for v, s in found.items() if (kinds[v] == "DecisionTreeRegressionModel") == single}
        if not folders:
            continue
        data = _by_version(spark.read.parquet(*[f"{p}/data" for p in folders.values()]), folders)
        rows = data.select("model_version", *([F.lit(0).alias("tree"), F.struct("*").alias("n")] if single else [F.col("treeID").alias("tree"), F.col("nodeData").alias("n")]))
        if single:
            rows = rows.withColumn("weight", F.lit(1.0))
        else:
            weights = _by_version(spark.read.parquet(*[f"{p}/treesMetadata" for p in folders.values()]), folders)
            weights = weights.select("model_version", F.col(weights.columns[0]).alias("tree"), F.col(weights.columns[2]).cast("double").alias("w"))
            rows = rows.join(F.broadcast(weights), ["model_version", "tree"])  # a row for each tree of each model
            forests = [v for v, k in kinds.items() if k == "RandomForestRegressionModel"]
            trees = F.count("*").over(Window.partitionBy("model_version", "n.id"))
            rows = rows.withColumn("weight", F.when(F.col("model_version").isin(forests), 1.0 / trees).otherwise(F.col("w")))
        leaf = F.col("n.leftChild") < 0
        parts.append(rows.select("model_version", "tree", "weight", F.col("n.id").alias("node"), F.when(leaf, -1).otherwise(F.col("n.split.featureIndex")).alias("feature"),
                                 F.when(~leaf, F.col("n.split.leftCategoriesOrThreshold")[0]).alias("threshold"),
                                 F.when(~leaf, F.col("n.leftChild")).alias("left"), F.when(~leaf, F.col("n.rightChild")).alias("right"), F.col("n.prediction").alias("value")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def tree_expression(nodes: DataFrame, inputs: list[Column]) -> Column:
    """The prediction of one model's ``node_table`` rows as a column expression over its ``inputs`` (imputed, in assembler order)."""
    rows = {(r.tree, r.node): r for r in nodes.collect()}  # one model
    def grown(tree: int, node: int) -> Column:
        r = rows[tree, node]
        if r.feature < 0:
            return F.lit(r.value)
        return F.when(inputs[r.feature] <= F.lit(r.threshold), grown(tree, r.left)).otherwise(grown(tree, r.right))
    out = F.lit(0.0)
    for tree, node in sorted(k for k in rows if k[1] == 0):
        out = out + F.lit(rows[tree, node].weight) * grown(tree, node)
    return out


def packed_models(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row a version: ``inputs`` (name, mean), tree nodes as arrays with the trees' ``roots`` (node, weight) and ``depth``, ``intercept``
    and ``coefficients``. Takes pipelines of imputers, assemblers and one tree or linear model; ``UnsupportedModel`` otherwise."""
    stages = {version_of(p): saved_stages(spark, p) for p in paths}
    rows = []
    for v, chain in sorted(stages.items()):  # the models' parameters, a few names and numbers each
        source: dict[str, tuple[str, float | None]] = {}
        names: list[str] = []
        intercept, coefficients, depth = 0.0, [], 1
        for kind, path, params in chain:
            if kind == "ImputerModel":
                means = spark.read.parquet(f"{path}/data").first().asDict()
                outs = params.get("outputCols") or [params["outputCol"]]
                for c, o in zip(params.get("inputCols") or [params["inputCol"]], outs, strict=True):
                    source[o] = (c, float(means[c]))
            elif kind == "VectorAssembler":
                names = params["inputCols"]
            elif kind == "LinearRegressionModel":
                m = spark.read.parquet(f"{path}/data").first()
                intercept, coefficients = float(m["intercept"]), [float(x) for x in m["coefficients"]]
            elif kind in _TREES:
                depth = max(1, int(params["maxDepth"]))
            else:
                raise UnsupportedModel(f"{v}: {kind}")
        rows.append((v, [source.get(n, (n, None)) for n in names], intercept, coefficients, depth))
    linear = spark.createDataFrame(rows, "model_version STRING, inputs ARRAY<STRUCT<name: STRING, mean: DOUBLE>>, intercept DOUBLE, coefficients ARRAY<DOUBLE>, depth INT")
    with_trees = [p for p in paths if any(s[0] in _TREES for s in stages[version_of(p)])]
    if not with_trees:
        nodes = spark.createDataFrame([], NODE_SCHEMA)
    else:
        nodes = node_table(spark, with_trees)
    # places of all of a version's nodes in one array, tree after tree
    place = (F.row_number().over(Window.partitionBy("model_version").orderBy("tree", "node")) - 1).alias("place")
    placed = nodes.select("*", place)
    start = F.col("place") - F.col("node")  # node ids of a tree are 0, 1, 2, ...
    cell = F.struct("place", "feature", "threshold", (start + F.col("left")).alias("left"), (start + F.col("right")).alias("right"), "value")
    packed = placed.groupBy("model_version").agg(F.sort_array(F.collect_list(cell)).alias("c"), F.sort_array(F.collect_list(
        F.when(F.col("node") == 0, F.struct("place", "weight")))).alias("roots"))
    packed = packed.select("model_version", *[F.col(f"c.{x}").alias(x) for x in ("feature", "threshold", "left", "right", "value")], "roots")
    return linear.join(packed, "model_version", "left")


def _values(df: DataFrame, names: list[str]) -> Column:
    """Input columns by name; NaN is missing, as for the imputer."""
    pairs = []
    for c in names:
        x = F.col(f"`{c}`").cast("double")
        pairs += [F.lit(c), F.when(~F.isnan(x), x)]
    return F.create_map(*pairs)


def _descend(model: str, x: Column, root: Column) -> Column:
    """The leaf that ``x`` reaches below ``root``: a step for each level of the version's deepest tree."""
    f, t, left, right = (F.col(f"{model}.{c}") for c in ("feature", "threshold", "left", "right"))
    step = lambda n: F.when(F.get(f, n) < 0, n).when(F.get(x, F.get(f, n)) <= F.get(t, n), F.get(left, n)).otherwise(F.get(right, n))
    return F.aggregate(F.sequence(F.lit(1), F.col(f"{model}.depth")), root, lambda n, _: step(n))


def _whole(df: DataFrame, names: list[str]) -> list[str]:
    """Those of the columns that hold whole numbers."""
    return [c for c in names if isinstance(df.schema[c].dataType, _WHOLE)]


def _stand_in(i: Column, whole: list[str]) -> Column:
    """What stands for the missing value of an input (name, mean); means of whole numbers here are not negative."""
    return F.when(i["name"].isin(whole), F.floor(i["mean"]).cast("double")).otherwise(i["mean"])


def with_inputs(df: DataFrame, names: list[str], model: str = "_model") -> DataFrame:
    """Add ``_x``, the inputs of the struct ``model`` in its order, missing ones by their means, and ``_linear``, its linear part; NULL if an input
    is missing and has no mean, or there is no model."""
    whole = _whole(df, names)
    m = lambda c: F.col(f"{model}.{c}")
    x = F.transform(m("inputs"), lambda i: F.coalesce(F.try_element_at(F.col("_values"), i["name"]), _stand_in(i, whole)))
    rows = df.withColumn("_values", _values(df, names)).withColumn("_x", x)
    there = m("inputs").isNotNull() & ~F.exists("_x", lambda v: v.isNull())
    linear = F.aggregate(F.zip_with("_x", m("coefficients"), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0))) + m("intercept")
    return rows.withColumn("_linear", F.when(there, linear)).drop("_values")


def with_prediction(df: DataFrame, names: list[str], model: str = "_model") -> DataFrame:
    """Add ``prediction`` to rows that carry a packed model as the struct ``model``; NULL if an input is missing and has no mean, or there is no model."""
    m = lambda c: F.col(f"{model}.{c}")
    trees = F.aggregate(m("roots"), F.lit(0.0), lambda s, r: s + r["weight"] * F.get(m("value"), _descend(model, F.col("_x"), r["place"])))
    return with_inputs(df, names, model).withColumn("prediction", F.col("_linear") + F.coalesce(trees, F.lit(0.0))).drop("_x", "_linear")


def _trees(row) -> tuple | None:
    """The trees of one packed model as arrays (feature, threshold, left, right, value, roots, weights, depth); a leaf is its own child on both sides."""
    if not row.roots:
        return None
    feature = np.array(row.feature, np.int64)
    leaf, own = feature < 0, np.arange(len(feature))
    child = lambda c: np.where(leaf, own, np.array([-1 if v is None else v for v in c], np.int64))
    return (np.where(leaf, 0, feature), np.array([np.nan if t is None else t for t in row.threshold], np.float64), child(row.left), child(row.right),
            np.array(row.value, np.float64), np.array([r.place for r in row.roots]), np.array([r.weight for r in row.roots]), row.depth)


def _predictions(models: dict[str, tuple], names: list[str]):
    """UDF: prediction by version and the columns ``names``, a batch of rows at a time; NULL where there is none.

    ``models`` has each version's inputs (name, what stands for a missing one), intercept, coefficients and ``_trees``. The functions are
    nested, so tasks need numpy and Arrow only, not this package.
    """
    def leaves(trees, x):
        """The weighted sum of the leaves that each row of ``x`` reaches, tree after tree."""
        feature, threshold, left, right, value, roots, weights, depth = trees
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for root, weight in zip(roots, weights, strict=True):
            at = np.full(len(x), root)
            for _ in range(depth):
                at = np.where(x[rows, feature[at]] <= threshold[at], left[at], right[at])
            total += weight * value[at]
        return total

    def predicted(model, columns, n):
        """Predictions, and where there are any, of ``n`` rows of input ``columns`` (NaN: missing); summed in the order of ``with_prediction``."""
        inputs, intercept, coefficients, trees = model
        x, there = np.empty((n, len(inputs))), np.ones(n, bool)
        for i, (name, mean) in enumerate(inputs):
            x[:, i] = columns.get(name, np.nan)
            missing = np.isnan(x[:, i])
            if mean is None:
                there &= ~missing
            else:
                x[missing, i] = mean
        linear = np.zeros(n)
        with np.errstate(all="ignore"):
            for i, c in enumerate(coefficients[:len(inputs)]):
                if c is not None:
                    linear += x[:, i] * c
            linear += intercept
            return linear + (leaves(trees, x) if trees else 0.0), there

    @F.arrow_udf("double")
    def predictions(version: pa.Array, *columns: pa.Array) -> pa.Array:
        out, there = np.zeros(len(version)), np.zeros(len(version), bool)
        values = {c: a.to_numpy(zero_copy_only=False) for c, a in zip(names, columns, strict=True)}  # NULL as NaN
        asked = version.dictionary_encode()
        code = asked.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        for k, v in enumerate(asked.dictionary.to_pylist()):
            if v in models:
                mine = np.flatnonzero(code == k)
                out[mine], there[mine] = predicted(models[v], {c: a[mine] for c, a in values.items()}, len(mine))
        return pa.array(out, mask=~there)
    return predictions


def predict(df: DataFrame, models: DataFrame, names: list[str], spread: str, only: Column | None = None) -> DataFrame:
    """``df`` (with ``model_version`` and the input columns ``names``) with ``prediction`` by its version's model; with ``only``, NULL where that isn't true.

    Naming a column of ``df`` in ``only`` also keeps its computation below the Python step: a column that is asked for twice is not computed
    after it, so the columns it was made from don't go through that step with every row.

    ``models`` (``packed_models``) go to every task if their arrays have at most ``MAX_BROADCAST_ELEMENTS`` elements: a batch of rows of a version
    fills in its inputs, sums its linear part and walks its trees as arrays. Beyond, a version's rows are
    dealt to ``SALTS`` copies of its model by the column ``spread``, since one version may hold most rows.
    """
    elements = models.agg(F.sum(5 * F.coalesce(F.size("value"), F.lit(0)) + 2 * F.size("inputs"))).first()[0] or 0
    if elements <= MAX_BROADCAST_ELEMENTS:
        whole = _whole(df, names)
        stands = F.transform("inputs", lambda i: F.struct(i["name"].alias("name"), _stand_in(i, whole).alias("mean")))
        found = models.filter("inputs IS NOT NULL AND intercept IS NOT NULL AND coefficients IS NOT NULL").withColumn("inputs", stands)
        packed = {r.model_version: ([(i["name"], i["mean"]) for i in r.inputs], r.intercept, r.coefficients, _trees(r))
                  for r in found.collect()}  # at most the elements that go to every task
        asked = {name for inputs, *_ in packed.values() for name, _ in inputs}
        names = [c for c in names if c in asked]  # what no model takes is neither computed nor sent to Python
        version = F.col("model_version") if only is None else F.when(only, F.col("model_version"))
        return df.select("*", _predictions(packed, names)(version, *[F.col(f"`{c}`").cast("double") for c in names]).alias("prediction"))
    packed = models.select("model_version", F.struct(*[c for c in models.columns if c != "model_version"]).alias("_model"))
    each = packed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).join(each, ["model_version", "_salt"], "left").drop("_salt")
    prediction = F.col("prediction") if only is None else F.when(only, F.col("prediction"))
    return with_prediction(joined, names).select(*df.columns, prediction.alias("prediction"))
