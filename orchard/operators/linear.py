"""Least squares by normal equations.

One aggregation gives the means and the covariances of all features and the
label, k (k + 3) / 2 numbers for k features whatever the rows; Spark merges
them pairwise, so partitions add up without cancellation.  The k x k system is
solved on the driver, and the fit is a plain column expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LinearFit:
    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    n_rows: int

    def predict(self) -> Column:
        out = F.lit(self.intercept)
        for name, c in zip(self.features, self.coefficients):
            out = out + F.lit(c) * F.col(name).cast("double")
        return out


def gram(df: DataFrame, features: list[str], label: str) -> tuple[np.ndarray, np.ndarray, int]:
    """(means, covariances, rows) of the features and, last, the label, over
    the rows where none of them is null: one pass, one result row."""
    names = [*features, label]
    cols = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)]
    complete = df.select(*cols).dropna()
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    row = complete.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f"x{i}").alias(f"m{i}") for i in range(len(names))],
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    means = np.array([row[f"m{i}"] or 0.0 for i in range(len(names))])
    cov = np.zeros((len(names), len(names)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = row[f"c{i}_{j}"] or 0.0
    return means, cov, row["n"]


def solve(means: np.ndarray, cov: np.ndarray, ridge: float = 0.0) -> tuple[np.ndarray, float]:
    """Coefficients and intercept.  Features are scaled to unit variance before
    the system is solved; one without variance gets 0, and among features that
    determine each other the smallest coefficients are taken.  ``ridge`` is
    added to the diagonal of the scaled system (the intercept is free)."""
    k = means.size - 1
    sd = np.sqrt(np.maximum(np.diag(cov)[:k], 0.0))
    live = sd > 1e-12 * np.maximum(1.0, np.abs(means[:k]))
    beta = np.zeros(k)
    if live.any():
        s = sd[live]
        a = cov[:k, :k][np.ix_(live, live)] / np.outer(s, s) + ridge * np.eye(int(live.sum()))
        beta[live] = np.linalg.lstsq(a, cov[:k, k][live] / s, rcond=1e-12)[0] / s
    return beta, float(means[k] - beta @ means[:k])


def fit_linear(df: DataFrame, features: list[str], label: str, ridge: float = 0.0) -> LinearFit:
    """Least squares of ``label`` on ``features`` with an intercept; rows with
    a null are left out; an empty input gives the zero function."""
    means, cov, n = gram(df, features, label)
    beta, intercept = solve(means, cov, ridge)
    return LinearFit(tuple(features), tuple(float(b) for b in beta), intercept, n)
