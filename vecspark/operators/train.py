"""Least squares as distributed aggregates.

The gradient trainers of the reference (O53-O56) are not rebuilt: see README, "Not built"."""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .partials import merged_state


def _merge_gram(a: dict, b: dict) -> dict:
    """Moments of two groups of rows as those of all, about the common mean."""
    n = a["n"] + b["n"]
    gap = b["mean"] - a["mean"]
    return {"n": n, "mean": a["mean"] + gap * (b["n"] / n), "gram": a["gram"] + b["gram"] + np.outer(gap, gap) * (a["n"] * b["n"] / n)}


def _gram(state, b):
    x = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1)
    mean = x.mean(axis=0)
    off = x - mean
    one = {"n": len(x), "mean": mean, "gram": off.T @ off}
    return one if state is None else _merge_gram(state, one)


def centred_moments(df: DataFrame, cols: list[str]) -> dict | None:
    """Row count, means and the Gram matrix of the centred columns, over rows without a null in any of them; None
    without such a row. One matrix a task, merged in a tree; the result is as large as the columns squared."""
    x = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]).dropna()
    got = merged_state(x, _gram, _merge_gram).collect()
    return pickle.loads(got[0]["state"]) if got else None


def fit_ols(df: DataFrame, x_cols: list[str], y_col: str) -> DataFrame:
    """Ordinary least squares with intercept. A row with a null in any feature or in ``y`` is left out as a whole.

    One feature: ``regr_slope / regr_intercept / regr_r2`` (one aggregate pass). Several features: the Gram
    matrix of the centred columns, gathered as one matrix a task, and a least-squares solution of its
    equations on the driver (dependent features get the shortest solution).
    Returns ``<term, coef>`` rows plus ``r2`` and ``n`` as extra terms; null coefficients without a row.
    """
    spark = df.sparkSession
    if len(x_cols) == 1:
        y, x = F.col(y_col).cast("double"), F.col(x_cols[0]).cast("double")
        return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                      F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))
    m = centred_moments(df, [*x_cols, y_col])
    if m is None:
        return spark.createDataFrame([(t, None) for t in ("intercept", *x_cols, "r2")] + [("n", 0.0)], "term string, coef double")
    gram, mean = m["gram"], m["mean"]
    scale = np.sqrt(np.maximum(np.diag(gram)[:-1], 1e-300))  # columns of unit length
    beta = np.linalg.lstsq(gram[:-1, :-1] / np.outer(scale, scale), gram[:-1, -1] / scale, rcond=1e-12)[0] / scale
    rest = gram[-1, -1] - 2 * beta @ gram[:-1, -1] + beta @ gram[:-1, :-1] @ beta
    out = [("intercept", float(mean[-1] - beta @ mean[:-1])), *zip(x_cols, map(float, beta)),
           ("r2", float(1 - rest / gram[-1, -1]) if gram[-1, -1] > 0 else None), ("n", float(m["n"]))]
    return spark.createDataFrame(out, "term string, coef double")
