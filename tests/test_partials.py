"""Per-task vectors merged in a tree: column reductions, column arg-max, least squares."""

import math

import numpy as np

from vecspark.operators import tensor as TS
from vecspark.operators.train import fit_ols


def test_columns_with_nulls_and_ragged_rows(spark):
    rows = [(0, [1.0, None, 3.0]), (1, None), (2, [5.0, 2.0]), (3, [5.0, 2.0, -7.0, None]), (4, []), (None, [99.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    got = {r.pos: r for r in TS.reduce_columns(df, "v").collect()}
    cols = {0: [1, 5, 5, 99], 1: [2, 2], 2: [3, -7]}
    for pos, x in cols.items():
        r = got[pos]
        assert (r["sum"], r["max"]) == (sum(x), max(x)) and math.isclose(r["mean"], np.mean(x)) and math.isclose(r["std"], np.std(x, ddof=1))
    assert tuple(got[3])[1:] == (None, None, None, None) and len(got) == 4
    arg = {r.pos: (r["max"], r["row"]) for r in TS.column_argmax(df, "id", "v").collect()}
    assert arg == {0: (5.0, 2), 1: (2.0, 2), 2: (3.0, 0), 3: (None, None)}
    assert TS.reduce_columns(df.limit(0), "v").collect() == []
    assert TS.column_argmax(df.limit(0), "id", "v").collect() == []


def test_many_tasks_shuffle_one_row_each(spark):
    x = np.random.default_rng(1).standard_normal((5000, 3)) + [1e6, 0, -3]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>").repartition(40)
    got = np.array([tuple(r)[1:] for r in TS.reduce_columns(df, "v").orderBy("pos").collect()])
    assert np.allclose(got, np.stack([x.sum(0), x.max(0), x.mean(0), x.std(0, ddof=1)], axis=1), rtol=1e-12)
    assert [r["row"] for r in TS.column_argmax(df, "id", "v").orderBy("pos").collect()] == x.argmax(0).tolist()
    plan = TS.column_argmax(df, "id", "v")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "hashpartitioning" not in plan


def test_nan_counts_as_the_largest(spark):
    df = spark.createDataFrame([(3, [float("nan")]), (1, [5.0]), (2, [float("nan")])], "id long, v array<double>").repartition(3)
    r = TS.column_argmax(df, "id", "v").first()
    assert math.isnan(r["max"]) and r["row"] == 2


def test_least_squares_leaves_out_rows_with_nulls(spark):
    r = np.random.default_rng(0)
    a, b = r.standard_normal(40) + 1e4, r.standard_normal(40)
    rows = [(float(x), float(z), float(2 * x + 3 * z + 1)) for x, z in zip(a, b)]
    rows += [(None, 1.0, 50.0), (None, 2.0, -9.0), (1.0, None, 7.0), (1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, y double").repartition(5)
    t = {q.term: q.coef for q in fit_ols(df, ["a", "b"], "y").collect()}
    assert np.allclose([t["intercept"], t["a"], t["b"], t["r2"], t["n"]], [1, 2, 3, 1, 40], atol=1e-6)
    empty = {q.term: q.coef for q in fit_ols(df.where("y > 1e9"), ["a", "b"], "y").collect()}
    assert empty == {"intercept": None, "a": None, "b": None, "r2": None, "n": 0.0}
    twice = df.withColumn("c", df["a"] * 2)  # dependent features
    t = {q.term: q.coef for q in fit_ols(twice, ["a", "b", "c"], "y").collect()}
    assert math.isclose(t["a"] + 2 * t["c"], 2, abs_tol=1e-6) and math.isclose(t["r2"], 1)
