"""Least squares and ridge regression in DuckDB SQL, the independent check of the linear models.

``regressed(rows, features, reg)`` gives CTEs over a CTE (v, row_no, y, w, the features) that fit each ``v`` apart, on the rows of ``w`` 1; the last one, ``regression``, has
the prediction of every row. Features and label are scaled to mean 0 and deviation 1 and orthogonalised one after another (Gram-Schmidt), so no
system is solved; the penalty enters as one more row for each feature, with sqrt(n * reg / deviation of the label) there and 0 elsewhere.
A feature that does not vary has coefficient 0.
"""

from __future__ import annotations


def regressed(rows: str, features: list[str], reg: float = 0.0) -> str:
    xs = [f"x{i}" for i in range(len(features))]
    mean = lambda c: f"(sum(w * {c}) OVER p / sum(w) OVER p)"
    scaled = ", ".join(f"coalesce(({c} - {mean(c)}) / nullif(stddev_pop(CASE WHEN w = 1 THEN {c} END) OVER p, 0), {c} - {c}) AS {x}" for c, x in zip(features, xs))
    parts = [f"scaled AS (SELECT v, row_no, w, {scaled}, (y - {mean('y')}) / stddev_pop(CASE WHEN w = 1 THEN y END) OVER p AS z, {mean('y')} AS my, "
             f"stddev_pop(CASE WHEN w = 1 THEN y END) OVER p AS sy FROM {rows} WINDOW p AS (PARTITION BY v))"]
    extra = ""
    if reg:
        per = f"(SELECT v, any_value(my) AS my, any_value(sy) AS sy, sqrt(sum(w) * {reg} / any_value(sy)) AS r FROM scaled GROUP BY v)"
        cells = ", ".join(f"CASE WHEN j = {i} THEN r ELSE 0 END" for i in range(len(xs)))
        extra = f" UNION ALL SELECT v, NULL, 1, {cells}, 0, my, sy, CAST(0 AS DOUBLE) FROM {per}, range({len(xs)}) t(j)"
    parts.append(f"gs0 AS (SELECT v, row_no, w, {', '.join(xs)}, z, my, sy, CAST(0 AS DOUBLE) AS fit FROM scaled{extra})")
    for i, x in enumerate(xs):
        share = lambda c: f"coalesce(sum(w * {c} * {x}) OVER p / nullif(sum(w * {x} * {x}) OVER p, 0), 0)"
        rest = "".join(f"{c} - {x} * ({share(c)}) AS {c}, " for c in xs[i + 1:])
        parts.append(f"gs{i + 1} AS (SELECT v, row_no, w, {rest}z - {x} * ({share('z')}) AS z, my, sy, fit + {x} * ({share('z')}) AS fit "
                     f"FROM gs{i} WINDOW p AS (PARTITION BY v))")
    parts.append(f"regression AS (SELECT v, row_no, w, my + sy * fit AS prediction FROM gs{len(xs)} WHERE row_no IS NOT NULL)")
    return ",\n".join(parts)
