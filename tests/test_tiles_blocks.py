"""Images in tiles with halos, matrices re-indexed across rows, saved vectors of which only some are read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecspark.functions import nn
from vecspark.operators import blocks as B
from vecspark.operators import tiles as TI
from vecspark.sources import embeddings_io as IO


def segments(spark, images, cut):
    rows = []
    for i, x in images.items():
        for ch, plane in enumerate(x):
            for y, row in enumerate(plane):
                rows += [(i, ch, y, a, row[a:a + cut].tolist()) for a in range(0, len(row), cut)]
    return spark.createDataFrame(rows, TI.SEGMENT).repartition(5)


def planes(df):
    out = {}
    for r in TI.pixels(df).collect():
        out.setdefault(r.id, {})[(r.ch, r.y, r.x)] = r.v
    return out


@pytest.mark.parametrize("tile,cut", [(4, 99), (6, 5), (64, 3)])
def test_layers_equal_those_of_whole_images(spark, tile, cut):
    r = np.random.default_rng(7)
    images = {3: r.standard_normal((2, 13, 17)), 8: r.standard_normal((2, 5, 30)), 9: r.standard_normal((2, 2, 40))}
    w, b = r.standard_normal((3, 2, 3, 3)), r.standard_normal(3)
    df = segments(spark, images, cut)
    one = planes(TI.conv2d_tiles(df, w, b, tile))
    pooled = planes(TI.conv2d_tiles(df, w, b, tile, relu=True, pool=2))
    plain = planes(TI.max_pool_tiles(df, 2, tile))
    two = planes(TI.conv2d_tiles(TI.conv2d_tiles(df, w, b, tile, relu=True, pool=2), r.standard_normal((1, 3, 2, 2)), np.zeros(1), tile))
    assert 9 not in one and set(two) <= {3, 8}   # lower than the kernel
    for i, x in images.items():
        assert {k: round(v, 9) for k, v in plain[i].items()} == {k: round(v, 9) for k, v in np.ndenumerate(nn.max_pool(x[None])[0])}
        if i != 9:
            c = nn.conv2d(x[None], w, b)
            for got, want in ((one[i], c[0]), (pooled[i], nn.max_pool(np.maximum(c, 0))[0])):
                assert set(got) == {k for k, _ in np.ndenumerate(want)}
                assert all(abs(got[k] - v) < 1e-12 for k, v in np.ndenumerate(want))


def test_one_exchange_and_gaps(spark):
    df = segments(spark, {0: np.ones((1, 9, 9))}, 4)
    plan = TI.conv2d_tiles(df, np.ones((1, 1, 3, 3)), np.zeros(1), 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    with pytest.raises(Exception, match="no pixels"):
        TI.conv2d_tiles(df.where("not (y = 4 and x0 = 0)"), np.ones((1, 1, 3, 3)), np.zeros(1), 64).collect()
    with pytest.raises(ValueError, match="multiple"):
        TI.max_pool_tiles(df, 2, 5)
    assert TI.max_pool_tiles(df.limit(0), 2, 4).collect() == []


@pytest.mark.parametrize("size", [3, 7, 4096])
def test_reshape_and_transpose_across_rows(spark, size):
    x = np.random.default_rng(1).standard_normal((24, 10))
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "id long, vec array<double>, row int").repartition(4)
    for shape in ((16, 15), (240, 1), (1, 240), (5, 48)):
        got = B.cells(B.reshape_rows(df, "id", "vec", 10, 24, *reversed(shape), size=size), size).collect()
        assert {(r.row, r.col): r.v for r in got} == dict(np.ndenumerate(x.reshape(shape)))
    blocks = B.transpose_rows(df, "id", "vec", 10, size)
    assert {(r.row, r.col): r.v for r in B.cells(blocks, size).collect()} == dict(np.ndenumerate(x.T))
    assert blocks.agg(F.max(F.size("vals"))).first()[0] <= size
    assert B.transpose_rows(df.limit(0), "id", "vec", 10, size).collect() == []
    with pytest.raises(ValueError, match="reshape"):
        B.reshape_rows(df, "id", "vec", 10, 24, 7)
    with pytest.raises(Exception, match="not 9 long"):
        B.transpose_rows(df, "id", "vec", 9, size).collect()


def scanned(df):
    """Files and rows that the Parquet scans of an executed plan gave."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.collect()
        plan, found, rows = df._jdf.queryExecution().executedPlan(), 0, 0
        leaves = plan.collectLeaves()
        for i in range(leaves.size()):
            m = leaves.apply(i).metrics()
            if m.contains("numFiles"):
                found, rows = found + m.apply("numFiles").value(), rows + m.apply("numOutputRows").value()
        return found, rows
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def test_lookup_reads_only_buckets_of_its_keys(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "sets")
    df = spark.range(5000).select(F.explode(F.array(F.lit("a"), F.lit("b"))).alias("model"), (F.col("id") - 100).alias("word_id"),
                                  F.array(F.col("id").cast("double")).alias("vec"))
    IO.save_embeddings(df, path, bucket=100)
    keys = spark.createDataFrame([(1, "a", 7), (2, "a", 8), (3, "a", 1234), (4, "a", 99_999), (5, "a", -3), (6, None, 7), (7, "a", None), (8, "a", 7)],
                                 "k int, model string, word_id long")
    want = {1: 107.0, 2: 108.0, 3: 1334.0, 4: None, 5: 97.0, 6: None, 7: None, 8: 107.0}
    assert {r.k: r.vec and r.vec[0] for r in IO.lookup_embeddings(spark, path, keys, 100).collect()} == want
    files, rows = scanned(IO.lookup_embeddings(spark, path, keys, 100))
    all_files, all_rows = scanned(spark.read.parquet(path))
    assert all_rows == 10_000 and rows <= 4 * 100 and files <= 6 < all_files // 10
    monkeypatch.setattr(IO, "LISTED_KEYS", 2)   # many keys are joined
    assert {r.k: r.vec and r.vec[0] for r in IO.lookup_embeddings(spark, path, keys, 100).collect()} == want
    assert IO.lookup_embeddings(spark, path, keys.limit(0), 100).collect() == []
    assert [r.vec for r in IO.lookup_embeddings(spark, path, keys.where("model is null"), 100).collect()] == [None]
