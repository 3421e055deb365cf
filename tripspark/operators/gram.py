"""Linear regression from mergeable sufficient statistics (M6).

One aggregate sums, for each group of rows, the count, the sums and the sums of products of the features and the label: (k+2)(k+3)/2
numbers whatever the number of rows. Such statistics add, so the model of versions 1..v comes from the sums of its batches, and a
new batch never rescans the old ones. Solving is a system of k equations.

``solve`` scales features and label to mean 0 and deviation 1 and minimises 1/(2n) sum (y - xb)^2 + reg/(2 s_y) sum b^2, which is what
``LinearRegression(regParam=reg, elasticNetParam=0)`` fits; ``reg`` 0 is least squares. A feature that does not vary has coefficient 0. Rows with a
NULL or NaN feature or label are left out, as the assembler skips them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import LABEL


#: Fixed points near the data of columns that lie far from 0 with a small spread.
SHIFT = {"pickup_longitude": -74.0, "dropoff_longitude": -74.0, "pickup_latitude": 41.0, "dropoff_latitude": 41.0}


def _pairs(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def statistics(rows: DataFrame, features: list[str], label: str = LABEL, by: list[str] | None = None) -> DataFrame:
    """(by, n, center, sums, products): sums over each group of the columns less ``center``, and of their products (upper triangle; label last).

    Columns are shifted by ``SHIFT``, the same for all groups, so that products of columns far from 0 do not cancel.
    """
    columns = [*features, label]
    value = [F.col(f"`{c}`").cast("double") for c in columns]
    whole = rows.filter(~F.exists(F.array(*value), lambda v: v.isNull() | F.isnan(v)))
    shift = [float(SHIFT.get(c, 0.0)) for c in columns]
    moved = [v - F.lit(s) for v, s in zip(value, shift, strict=True)]
    sums = [F.sum(m).alias(f"s{i}") for i, m in enumerate(moved)]
    products = [F.sum(moved[i] * moved[j]).alias(f"p{i}_{j}") for i, j in _pairs(len(columns))]
    # columns of sums, not an array aggregate: partial sums stay in generated code
    grouped = whole.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"), *sums, *products)
    return grouped.select(*(by or []), "n", F.array(*map(F.lit, shift)).alias("center"), F.array(*[f"s{i}" for i in range(len(columns))]).alias("sums"),
                          F.array(*[f"p{i}_{j}" for i, j in _pairs(len(columns))]).alias("products"))


def _flat(stats: DataFrame, by: list[str]) -> DataFrame:
    return stats.select(*by, "n", "center", F.size("sums").alias("k"), F.posexplode(F.concat("sums", "products")).alias("place", "x"))


def _gathered(flat: DataFrame, by: list[str]) -> DataFrame:
    """One row a group again from a row for each number."""
    rows = flat.groupBy(*by).agg(F.first("n").alias("n"), F.first("center").alias("center"), F.first("k").alias("k"),
                                 F.transform(F.sort_array(F.collect_list(F.struct("place", "x"))), lambda s: s["x"]).alias("all"))
    return rows.select(*by, "n", "center", F.expr("slice(all, 1, k)").alias("sums"), F.expr("slice(all, k + 1, size(all))").alias("products"))


def merged(stats: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Statistics of the union of groups (all, or those equal in ``by``): the sums of their numbers."""
    by = by or []
    each = _flat(stats, by).groupBy(*by, "place").agg(F.sum("x").alias("x"), F.sum("n").alias("n"), F.first("center").alias("center"), F.first("k").alias("k"))
    return _gathered(each, by)


def running(stats: DataFrame, by: str) -> DataFrame:
    """Statistics of the groups up to each one in the order of ``by``: running sums of each number, nothing rescanned."""
    upto = Window.partitionBy("place").orderBy(by)
    sums = _flat(stats, [by]).withColumn("x", F.sum("x").over(upto)).withColumn("n", F.sum("n").over(upto))
    return _gathered(sums, [by])


def solve(n: int, center, sums, products, reg: float = 0.0) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) from one row of statistics."""
    k1 = len(sums)
    s = np.array(sums, float)
    full = np.zeros((k1, k1))
    for (i, j), x in zip(_pairs(k1), products, strict=True):
        full[i, j] = full[j, i] = x
    mean = s / n
    cov = full / n - np.outer(mean, mean)
    var = np.diag(cov)
    varies = np.flatnonzero(var[:-1] > 1e-12 * np.diag(full)[:-1] / n)
    coef = np.zeros(k1 - 1)
    if len(varies) and var[-1] > 0:
        sd, sy = np.sqrt(var[varies]), np.sqrt(var[-1])
        scaled = cov[np.ix_(varies, varies)] / np.outer(sd, sd) + reg / sy * np.eye(len(varies))
        coef[varies] = np.linalg.lstsq(scaled, cov[varies, -1] / (sd * sy), rcond=None)[0] * sy / sd
    at = mean + np.array(center, float)
    return coef, float(at[-1] - at[:-1] @ coef)


def fit(rows: DataFrame, features: list[str], label: str = LABEL, reg: float = 0.0) -> tuple[np.ndarray, float, int]:
    """(coefficients, intercept, rows) of one model: one aggregate over ``rows``."""
    r = statistics(rows, features, label).first()
    if not r["n"]:
        raise ValueError("no rows without missing values")
    return *solve(r["n"], r["center"], r["sums"], r["products"], reg), r["n"]


def fit_versions(rows: DataFrame, features: list[str], by: str = "batch_no", label: str = LABEL, reg: float = 0.0) -> DataFrame:
    """(by, n, coefficients, intercept): the model of all batches up to each one, from one scan of ``rows``."""
    spark = rows.sparkSession
    stats = running(statistics(rows, features, label, [by]), by)
    out = []
    for r in stats.collect():  # one row of sums for each version
        coef, intercept = solve(r["n"], r["center"], r["sums"], r["products"], reg)
        out.append((int(r[by]), int(r["n"]), [float(x) for x in coef], intercept))
    return spark.createDataFrame(out, f"{by} INT, n BIGINT, coefficients ARRAY<DOUBLE>, intercept DOUBLE")


def score(rows: DataFrame, features: list[str], coefficients, intercept: float, out: str = "prediction") -> DataFrame:
    """``rows`` with the prediction of one model as a native expression; NULL where a feature is NULL."""
    e = F.lit(float(intercept))
    for c, b in zip(features, coefficients, strict=True):
        e = e + F.col(f"`{c}`").cast("double") * F.lit(float(b))
    return rows.withColumn(out, e)



def packed(models: DataFrame, features: list[str], by: str = "batch_no") -> DataFrame:
    """Models of ``fit_versions`` as rows of ``ensembles.packed_models``: version ``v<by>``, no means, so a missing input gives no prediction."""
    inputs = F.array(*[F.struct(F.lit(c).alias("name"), F.lit(None).cast("double").alias("mean")) for c in features])
    ints, doubles = "array<int>", "array<double>"
    kinds = {"feature": ints, "threshold": doubles, "left": ints, "right": ints, "value": doubles, "roots": "array<struct<place: int, weight: double>>"}
    return models.select(F.concat(F.lit("v"), F.col(by)).alias("model_version"), inputs.alias("inputs"), "intercept", "coefficients", F.lit(1).alias("depth"),
                         *[F.lit(None).cast(k).alias(c) for c, k in kinds.items()])
