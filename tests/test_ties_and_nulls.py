"""Equal vectors tie whatever their place; null vectors are not scored; launch settings stay."""

import os
import subprocess
import sys

import numpy as np
import pytest

from vecspark.operators import embed as E
from vecspark.operators import layers as L
from vecspark.operators import tensor as TS


@pytest.mark.parametrize("batch", [777, 10000])
def test_duplicates_tie_to_the_lowest_id(spark, batch):
    v = np.random.default_rng(0).standard_normal(300).tolist()
    from pyspark.sql import functions as F
    vecs = spark.range(1, 10001).select(F.lit("m").alias("model"), F.col("id").alias("word_id"),
                                        F.array(*map(F.lit, v)).alias("vec")).coalesce(1)
    q = spark.createDataFrame([(0, "m", [x + 0.1 for x in v])], "qid long, model string, qvec array<double>")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        for k in (1, 100):
            got = sorted(r.word_id for r in E.similarity_scan(vecs, q, k=k).collect())
            assert got == list(range(1, k + 1))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_null_vectors_get_null_scores(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [0.0, 1.0])], "id long, v array<double>")
    params = {"fc.weight": np.array([[1.0, 0.0], [0.0, 1.0]]), "fc.bias": np.array([5.0, 7.0])}
    for part in (df.coalesce(1), df.where("id = 2")):
        got = {r.id: (r.scores, r.pred) for r in L.apply_network(part, "v", [("linear", "fc")], params, ["id"]).collect()}
        assert got[2] == (None, None)
        assert got.get(1, ([6.0, 9.0], 1)) == ([6.0, 9.0], 1)


def test_context_mean_takes_any_id(spark):
    big = 4_000_000_000
    win = spark.createDataFrame([(1, big, 7)], "k long, a long, b long")
    vecs = spark.createDataFrame([(big, [1.0, 2.0]), (7, [3.0, 4.0])], "word_id long, vec array<double>")
    assert TS.context_mean(win, vecs, ["a", "b"], ["k"]).first().mean == [2.0, 3.0]


def test_launch_settings_stay():
    code = "from vecspark.session import build_session; s = build_session('local[1]'); print('GOT', s.conf.get('spark.sql.shuffle.partitions'))"
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--conf spark.sql.shuffle.partitions=64 pyspark-shell"}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], env=env, cwd=root, capture_output=True, text=True, timeout=120)
    assert "GOT 64" in out.stdout, out.stderr[-500:]
