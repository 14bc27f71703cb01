"""Linear models from cross moments.

One aggregate pass gives the sums of products of all features and the target. They are
combined map-side, so a model over any number of rows, or one model per series, costs one
small row per model; the solves are on matrices the size of the feature list.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def moments(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str] = ()) -> DataFrame:
    """Count, means and covariances of the complete rows as one array per group.

    The built-in moments are centred while they are merged, so large tables keep their precision.
    """
    columns = [F.col(n).cast("double") for n in (*features, target)]
    spread = [F.covar_pop(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    parts = [F.count(F.lit(1)).cast("double"), *[F.avg(c) for c in columns], *spread]
    return df.dropna(subset=[*features, target]).groupBy(*keys).agg(F.array(*parts).alias("moments"))


def _unpack(m: Sequence[float], p: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Count, means and centred product matrix over p features and the target."""
    m, size = np.asarray(m, dtype=float), p + 1
    table = np.zeros((size, size))
    table[np.triu_indices(size)] = m[1 + size :]
    table = table + table.T - np.diag(np.diag(table))
    return m[0], m[1 : 1 + size], m[0] * table


def _merge(a, b):
    """Moments of two disjoint sets of rows together."""
    n = a[0] + b[0]
    gap = b[1] - a[1]
    return n, a[1] + gap * b[0] / n, a[2] + b[2] + np.outer(gap, gap) * a[0] * b[0] / n


def solve_ridge(parts, p: int, alpha: float = 0.0) -> tuple[float, np.ndarray, float]:
    """Intercept (not penalised), coefficients and residual sum of squares."""
    n, mean, c = parts
    xx, xy, yy = c[:p, :p], c[:p, p], c[p, p]
    weights = np.linalg.lstsq(xx + alpha * np.eye(p), xy, rcond=None)[0]
    rss = yy - 2 * weights @ xy + weights @ xx @ weights
    return float(mean[p] - weights @ mean[:p]), weights, float(rss)


def ridge(df: DataFrame, features: Sequence[str], target: str, alpha: float = 0.0) -> dict[str, float]:
    """Ridge (or plain least squares) over the whole table."""
    row = moments(df, features, target).first()
    intercept, weights, _ = solve_ridge(_unpack(row["moments"], len(features)), len(features), alpha)
    return {"intercept": intercept, **dict(zip(features, weights.tolist()))}


def ridge_by_cross_validation(
    df: DataFrame, features: Sequence[str], target: str, fold: str, alphas: Sequence[float]
) -> tuple[DataFrame, dict[str, float]]:
    """Penalty chosen by k-fold error, with one pass over the data for all folds and penalties.

    The moments of a training part are those of the other folds merged, and a fold's error
    follows from its own moments as well.
    """
    p = len(features)
    parts = [_unpack(r["moments"], p) for r in moments(df, features, target, [fold]).collect()]
    total = reduce(_merge, parts)
    scores = []
    for alpha in alphas:
        error = 0.0
        for i, (n, mean, c) in enumerate(parts):
            intercept, w, _ = solve_ridge(reduce(_merge, parts[:i] + parts[i + 1 :]), p, alpha)
            bias = mean[p] - intercept - w @ mean[:p]
            error += c[p, p] - 2 * w @ c[:p, p] + w @ c[:p, :p] @ w + n * bias * bias
        scores.append((float(alpha), float(np.sqrt(error / total[0]))))
    best = min(scores, key=lambda s: s[1])[0]
    intercept, weights, _ = solve_ridge(total, p, best)
    table = df.sparkSession.createDataFrame(scores, "alpha DOUBLE, rmse DOUBLE")
    return table, {"alpha": best, "intercept": intercept, **dict(zip(features, weights.tolist()))}


def predict(coefficients: Mapping[str, float], features: Sequence[str]) -> Column:
    out = F.lit(coefficients["intercept"])
    for f in features:
        out = out + F.col(f) * F.lit(coefficients[f])
    return out


def series_models(df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, alpha: float = 0.0) -> DataFrame:
    """One ridge model per series: its rows never meet in one task, only their moments do."""
    p = len(features)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def solve(m: pd.Series) -> pd.Series:
        def one(v):
            intercept, weights, rss = solve_ridge(_unpack(v, p), p, alpha)
            return [intercept, *weights.tolist(), rss]

        return m.map(one)

    fitted = moments(df, features, target, keys).withColumn("_c", solve("moments"))
    return fitted.select(
        *keys,
        F.col("moments")[0].cast("long").alias("n"),
        F.col("_c")[0].alias("intercept"),
        *[F.col("_c")[i + 1].alias(f"b_{f}") for i, f in enumerate(features)],
        F.col("_c")[p + 1].alias("rss"),
    )


def _inflation(correlation: np.ndarray, i: int) -> float:
    """Variance inflation of one feature: 1 / (1 - R squared) against the others."""
    rest = [j for j in range(len(correlation)) if j != i]
    if not rest:
        return 1.0
    link = correlation[i, rest]
    unexplained = 1.0 - float(link @ np.linalg.pinv(correlation[np.ix_(rest, rest)]) @ link)
    return 1.0 / unexplained if unexplained > 1e-12 else float("inf")


def regression_diagnostics(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Sums of squares, F, R squared, adjusted R squared, t values and variance inflation per coefficient."""
    p = len(features)
    n, _, c = _unpack(moments(df, features, target).first()["moments"], p)
    xx, xy, tss = c[:p, :p], c[:p, p], c[p, p]
    inverse = np.linalg.pinv(xx)
    weights = inverse @ xy
    ssr = float(weights @ xy)
    sse = float(tss - ssr)
    dof = n - p - 1
    r2 = ssr / tss
    deviation = np.sqrt(np.diag(xx))
    correlation = xx / np.outer(deviation, deviation)
    vif = [_inflation(correlation, i) for i in range(p)]
    t = weights / np.sqrt(sse / dof * np.diag(inverse))
    rows = [
        (
            f, float(weights[i]), float(t[i]), float(vif[i]), bool(vif[i] > 10), float(tss), ssr, sse,
            float((ssr / p) / (sse / dof)), float(r2), float(1 - (1 - r2) * (n - 1) / dof),
        )
        for i, f in enumerate(features)
    ]
    schema = (
        "feature STRING, coefficient DOUBLE, t_value DOUBLE, vif DOUBLE, collinear BOOLEAN, tss DOUBLE, ssr DOUBLE, "
        "sse DOUBLE, f_value DOUBLE, r2 DOUBLE, adjusted_r2 DOUBLE"
    )
    return df.sparkSession.createDataFrame(rows, schema)
