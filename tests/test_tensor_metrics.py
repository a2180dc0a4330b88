"""Tensor, embedding and metric operators: tied arg-max, zero vector, missing classes, odd pooling."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecspark.functions import nn
from vecspark.functions import vec as V
from vecspark.operators import embed as E
from vecspark.operators import layers as L
from vecspark.operators import metrics as M
from vecspark.operators import tensor as TS
from vecspark.sources.literals import make_regression, random_table, tensor_table
from vecspark.operators.train import fit_ols


def test_tensor_table_types_and_shapes(spark):
    t = tensor_table(spark, [[1, 2, 3], [4, 5, 6]])
    assert t.schema["vec"].dataType.simpleString() == "array<bigint>"
    f = tensor_table(spark, [[1, 2], [3, 4]], dtype="double")
    assert f.schema["vec"].dataType.simpleString() == "array<double>"
    cube = tensor_table(spark, np.arange(27).reshape(3, 3, 3))
    s = TS.shape_of(cube, "vec").first()
    assert (s.n_rows, s.n_cols, s.numel, s.uniform) == (3, 9, 27, True)


def test_reshape_infers_axis(spark):
    lg = TS.to_long(tensor_table(spark, [list(range(12))]), "id", "vec")
    r = TS.reshape(lg, [3, -1], numel=12).orderBy("pos").collect()
    assert [(x.i0, x.i1) for x in r][:5] == [(0, 0), (0, 1), (0, 2), (0, 3), (1, 0)]
    try:
        TS.reshape(lg, [5, -1], numel=12)
        raise AssertionError("expected failure")
    except ValueError:
        pass


def test_image_layout_transpose_moves_channels(spark):
    h, w, c = 2, 3, 2
    img = np.arange(h * w * c).reshape(h, w, c)
    lg = TS.to_long(tensor_table(spark, [img.ravel().tolist()]), "id", "vec")
    got = {r.new_pos: r.v for r in TS.image_layout(lg, h, w, c, "transpose").collect()}
    exp = img.transpose(2, 0, 1).ravel()
    assert [got[i] for i in range(h * w * c)] == exp.tolist()
    same = {r.new_pos: r.v for r in TS.image_layout(lg, h, w, c, "reshape").collect()}
    assert [same[i] for i in range(h * w * c)] == img.ravel().tolist()


def test_argmax_ties_lowest(spark):
    df = spark.createDataFrame([(0, [1.0, 3.0, 3.0]), (1, [2.0, 2.0, 1.0])], "id long, vec array<double>")
    assert [r.idx for r in TS.argmax(df, "vec").orderBy("id").collect()] == [1, 0]
    ca = {r.pos: r.row for r in TS.column_argmax(df, "id", "vec").collect()}
    assert ca == {0: 1, 1: 0, 2: 0}


def test_reductions(spark):
    df = tensor_table(spark, [[1.0, 2.0], [3.0, 4.0], [5.0, 7.0]])
    r = TS.reduce_all(TS.to_long(df, "id", "vec")).first()
    x = np.array([1, 2, 3, 4, 5, 7.0])
    assert math.isclose(r["sum"], x.sum()) and math.isclose(r["std"], x.std(ddof=1)) and r["numel"] == 6
    cols = {q.pos: (q["sum"], q["max"]) for q in TS.reduce_columns(df, "vec").collect()}
    assert cols == {0: (9.0, 5.0), 1: (13.0, 7.0)}
    rows = [q["sum"] for q in TS.reduce_rows(df, "vec").orderBy("id").collect()]
    assert rows == [3.0, 7.0, 12.0]


def test_cosine_zero_vector(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0]), ([1.0, 0.0], [2.0, 0.0])], "a array<double>, b array<double>")
    assert [r.c for r in df.select(V.cosine("a", "b").alias("c")).collect()] == [0.0, 1.0]


def test_nearest_excludes_and_breaks_ties(spark):
    vecs = spark.createDataFrame([("m", 1, [1.0, 0.0]), ("m", 2, [1.0, 0.0]), ("m", 3, [0.9, 0.1]),
                                  ("m", 4, [0.0, 1.0])], "model string, word_id long, vec array<double>")
    q = spark.createDataFrame([(0, "m", [1.0, 0.0], [1]), (1, "m", [1.0, 0.0], [])],
                              "qid int, model string, qvec array<double>, exclude array<long>")
    got = {r.qid: r.word_id for r in E.nearest(vecs, q, "exclude").collect()}
    assert got == {0: 2, 1: 1}
    top = E.rank_by_distance(vecs, q.where("qid = 1"), k=3).orderBy("rank").collect()
    assert [r.word_id for r in top] == [1, 2, 3]
    rk = E.rank_of(vecs, q.where("qid = 1").withColumn("target", F.lit(3).cast("long")), "target").first()
    assert rk["rank"] == 3


def test_bincount_and_confusion_missing_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (2, 2), (2, 2)], "label int, pred int")
    assert sorted(map(tuple, M.bincount(df, "label").collect())) == [(0, 2), (1, 0), (2, 2)]
    cm = M.confusion_matrix(df, 3).collect()
    assert len(cm) == 9 and sum(r.n for r in cm) == 4
    acc = M.accuracy(df).first()
    trace = sum(r.n for r in cm if r.truth == r.pred)
    assert math.isclose(acc.accuracy, trace / 4)
    wide = {r.truth: (r.a, r.b, r.c) for r in M.confusion_matrix(df, 3, names=["a", "b", "c"], wide=True).collect()}
    assert wide == {0: (1, 0, 1), 1: (0, 0, 0), 2: (0, 0, 2)}


def test_nulls_and_values_outside_the_classes_are_counted(spark):
    rows = [(0, 0), (0, None), (1, 1), (None, 1), (7, 1), (1, -3), (None, None)]
    df = spark.createDataFrame(rows, "label int, pred int")
    acc = M.accuracy(df).first()
    assert (acc.num_correct, acc.n, acc.accuracy) == (2, 7, 2 / 7) and M.num_correct(df).first()[0] == 2
    long = {(r.truth, r.pred): r.n for r in M.confusion_matrix(df, 2, names=["a", "b"]).collect() if r.n}
    assert long == {(0, 0): 1, (0, -1): 1, (1, 1): 1, (-1, 1): 2, (1, -1): 1, (-1, -1): 1}
    names = {(r.truth_name, r.pred_name) for r in M.confusion_matrix(df, 2, names=["a", "b"]).collect()}
    assert ("other", "b") in names and len(names) == 8
    wide = {r.truth: tuple(r)[1:] for r in M.confusion_matrix(df, 2, wide=True).collect()}
    assert wide == {0: (1, 0, 1), 1: (0, 1, 1), -1: (0, 2, 1)}
    assert M.confusion_matrix(df.where("label = pred"), 2, wide=True).columns == ["truth", "p0", "p1"]
    empty = df.limit(0)
    assert tuple(M.accuracy(empty).first()) == (0, 0, None) and sum(r.n for r in M.confusion_matrix(empty, 2).collect()) == 0


def test_bincount_of_a_huge_label_is_distributed(spark):
    df = spark.createDataFrame([(100_000_000,), (3,), (3,)], "label int")
    got = M.bincount(df, "label")
    assert got.count() == 100_000_001
    assert sorted(map(tuple, got.where("n > 0").collect())) == [(3, 2), (100_000_000, 1)]
    assert M.bincount(df.limit(0), "label").collect() == []


def test_cross_entropy_matches_numpy(spark):
    S = np.array([[1.0, 2.0, 0.5], [0.1, 0.1, 3.0]])
    y = np.array([1, 0])
    df = spark.createDataFrame([(S[i].tolist(), int(y[i])) for i in range(2)], "scores array<double>, label int")
    got = M.cross_entropy(df).first().loss
    exp = -nn.log_softmax(S)[np.arange(2), y].mean()
    assert math.isclose(got, exp, rel_tol=1e-12)


def test_max_pool_odd_size_and_conv(spark):
    rng = np.random.default_rng(0)
    X = rng.standard_normal((2, 1, 5, 5))
    rows = [(n, 0, y, x, float(X[n, 0, y, x])) for n in range(2) for y in range(5) for x in range(5)]
    img = spark.createDataFrame(rows, "id long, ch int, y int, x int, v double")
    pooled = {(r.id, r.y, r.x): r.v for r in L.max_pool_long(img, 5, 5, 2).collect()}
    P = nn.max_pool(X, 2)
    assert P.shape == (2, 1, 2, 2)
    assert all(math.isclose(pooled[(n, y, x)], P[n, 0, y, x]) for n in range(2) for y in range(2) for x in range(2))
    K = rng.standard_normal((3, 1, 3, 3))
    b = rng.standard_normal(3)
    kern = spark.createDataFrame([(o, 0, i, j, float(K[o, 0, i, j])) for o in range(3) for i in range(3) for j in range(3)],
                                 "out_ch int, ch int, ky int, kx int, w double")
    bias = spark.createDataFrame([(o, float(b[o])) for o in range(3)], "out_ch int, b double")
    out = {(r.id, r.ch, r.y, r.x): r.v for r in L.conv2d_long(img, kern, bias, 5, 5, 3).collect()}
    C = nn.conv2d(X, K, b)
    assert len(out) == C.size
    assert all(math.isclose(out[(n, o, y, x)], C[n, o, y, x], abs_tol=1e-12)
               for n in range(2) for o in range(3) for y in range(3) for x in range(3))


def test_random_table_partition_independent(spark):
    a = {r.id: r.vec for r in random_table(spark, 50, 4, "normal", 7, partitions=1).collect()}
    b = {r.id: r.vec for r in random_table(spark, 50, 4, "normal", 7, partitions=5).collect()}
    assert a == b
    u = [x for v in random_table(spark, 200, 5, "uniform", 1).collect() for x in v.vec]
    assert 0 <= min(u) and max(u) < 1


def test_make_regression_and_ols(spark):
    df, coef = make_regression(spark, 2000, 1, noise=0.5, seed=1)
    r = fit_ols(df.select(F.col("x")[0].alias("x"), "y"), ["x"], "y").first()
    assert abs(r.slope - coef[0]) < 0.1 and r.n == 2000
    df3, coef3 = make_regression(spark, 2000, 3, noise=0.1, seed=2)
    t = {q.term: q.coef for q in fit_ols(df3.select(*[F.col("x")[i].alias(f"x{i}") for i in range(3)], "y"),
                                         ["x0", "x1", "x2"], "y").collect()}
    assert all(abs(t[f"x{i}"] - coef3[i]) < 0.05 for i in range(3)) and t["r2"] > 0.99


def test_embeddings_roundtrip_prunes_partitions(spark, tmp_path):
    from vecspark.sources import embeddings_io as IO
    df = spark.createDataFrame([("A", 1, [1.0]), ("B", 1, [2.0])], "model string, word_id long, vec array<double>")
    IO.save_embeddings(df, str(tmp_path / "e"))
    back = IO.load_embeddings(spark, str(tmp_path / "e"), ["B"])
    assert [tuple(r) for r in back.collect()] == [("B", 1, [2.0])]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "isnotnull(model" in plan or "model IN" in plan


def test_context_mean_both_paths_agree(spark):
    rng = np.random.default_rng(7)
    V_, d = 30, 5
    vecs = spark.createDataFrame([(i, rng.standard_normal(d).tolist()) for i in range(V_)], "word_id long, vec array<double>")
    rows = [(0, 0, p, *map(int, rng.integers(0, V_, 4))) for p in range(500)] + [(0, 1, 0, 0, 0, 99, 1)]
    win = spark.createDataFrame(rows, "doc_id long, line_no int, pos int, c1 int, c2 int, c3 int, c4 int").repartition(3)
    E_ = {r.word_id: np.array(r.vec) for r in vecs.collect()}
    fast = {(r.line_no, r.pos): np.array(r.mean) for r in
            TS.context_mean(win, vecs, ["c1", "c2", "c3", "c4"], ["doc_id", "line_no", "pos"]).collect()}
    slow = {(r.line_no, r.pos): np.array(r.mean) for r in
            TS.context_mean(win, vecs, ["c1", "c2", "c3", "c4"], ["doc_id", "line_no", "pos"],
                            broadcast_bytes=0).collect()}
    assert set(fast) == set(slow) == {(0, p) for p in range(500)} | {(1, 0)}
    assert fast.pop((1, 0)).item() is None and slow[(1, 0)].item() is None    # id 99 has no vector
    short = {(r.line_no, r.pos): (r.msum, r.mnorm) for r in
             TS.context_mean(win, vecs, ["c1", "c2", "c3", "c4"], ["doc_id", "line_no", "pos"], digest=True).collect()}
    assert short.pop((1, 0)) == (None, None)
    assert all(np.allclose(short[k], (v.sum(), np.linalg.norm(v))) for k, v in fast.items())
    for kk, v in fast.items():
        r = rows[kk[1]]
        exp = (E_[r[3]] + E_[r[4]] + E_[r[5]] + E_[r[6]]) / 4
        assert np.allclose(v, exp, atol=1e-14) and np.allclose(slow[kk], exp, atol=1e-14)


def test_shuffled_batches_partition_independent_and_stack_rows(spark):
    from vecspark.operators import windows as W
    df = spark.range(1000).select(F.col("id").alias("k"))
    a = {r.k: r.batch_id for r in W.assign_batches(df.repartition(1), size=32, shuffle=True, seed=3, id_col="k").collect()}
    b = {r.k: r.batch_id for r in W.assign_batches(df.repartition(6), size=32, shuffle=True, seed=3, id_col="k").collect()}
    sizes = sorted(list(a.values()).count(i) for i in set(a.values()))
    assert a == b and sizes == [1000 % 32] + [32] * (1000 // 32)
    assert len({i // 32 for i in a if a[i] == 0}) > 8   # a permutation, not runs of ids
    c = {r.k: r.batch_id for r in W.assign_batches(df, size=32, shuffle=True, seed=4, id_col="k").collect()}
    assert c != a
    seq = {r.k: r.batch_id for r in W.assign_batches(df, size=32, id_col="k").collect()}
    assert seq[31] == 0 and seq[32] == 1 and max(seq.values()) == W.n_passes(1000, 32) - 1
    t = [tensor_table(spark, [[i, i], [i, i]]) for i in (1, 2, 3)]
    st = TS.stack_rows(t).collect()
    assert len(st) == 6 and {(r.k, r.vec[0]) for r in st} == {(0, 1), (1, 2), (2, 3)}


def test_peek_is_first_rows_in_order(spark):
    from vecspark.operators import text as T
    df = spark.range(100).select((99 - F.col("id")).alias("x"))
    assert [r.x for r in T.peek(df, 3, ["x"]).collect()] == [0, 1, 2]


def test_argmax_overall_ties_lowest_flat_index(spark):
    df = spark.createDataFrame([(0, [1.0, 5.0, 2.0]), (1, [5.0, 0.0, 5.0])], "id long, vec array<double>")
    r = TS.argmax_all(df, "id", "vec", 3).first()
    assert (r.idx, r.max) == (1, 5.0)


def test_read_labelled_scales_and_prunes(spark):
    from vecspark.sources.vectors import read_labelled
    df = read_labelled(spark, "/root/testdata/sf0.001/embeddings.parquet", "vec_id", "embedding", "label", scale=255.0)
    raw = {r.vec_id: r.embedding for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()}
    r = df.orderBy("id").first()
    assert df.columns == ["id", "features", "label"]
    assert np.allclose(np.array(r.features) * 255.0, np.array(raw[r.id], dtype=np.float64), atol=1e-12)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>,label:int>" in plan


def test_context_mean_with_part_of_the_vectors_broadcast(spark, monkeypatch):
    """Frequent ids are broadcast; only windows with others travel, and only those ids' vectors. The key need not tell windows apart."""
    from vecspark.operators import joins
    rng = np.random.default_rng(8)
    E_ = {i: rng.standard_normal(5) for i in range(40)}
    vecs = spark.createDataFrame([(i, v.tolist()) for i, v in E_.items()], "word_id long, vec array<double>")
    rows = [(int(rng.integers(0, 3)), *map(int, np.minimum(rng.geometric(0.2, 4), 39))) for _ in range(3000)] + [(0, 39, 38, 39, 38)] * 3 + [(5, 99, 1, 2, 39), (6, None, 1, 2, 39), (7, None, 1, 2, 3)]
    win = spark.createDataFrame(rows, "target long, c1 int, c2 int, c3 int, c4 int").repartition(3)
    met, join = [], joins.salted_join
    monkeypatch.setattr(joins, "salted_join", lambda big, *a, **k: met.append(big.count()) or join(big, *a, **k))
    for limit in (1000, 0):
        got = TS.context_mean(win, vecs, ["c1", "c2", "c3", "c4"], ["target"], broadcast_bytes=limit).collect()
        whole = sorted((r.target, *np.round(r["mean"], 9)) for r in got if r["mean"] is not None)
        assert sorted(r.target for r in got if r["mean"] is None) == [5, 6, 7]
        assert whole == sorted((r[0], *np.round((E_[r[1]] + E_[r[2]] + E_[r[3]] + E_[r[4]]) / 4, 9)) for r in rows if None not in r and 99 not in r)
    assert met[0] < 0.25 * 4 * len(rows) < met[1]


@pytest.mark.parametrize("step", [1, 7])
def test_context_mean_over_slices_of_the_vectors(spark, monkeypatch, step):
    """A matrix beyond a worker's bound is broadcast some columns at a time: neither windows nor vectors are shuffled, whatever the ids."""
    from vecspark.operators import joins
    rng = np.random.default_rng(9)
    E_ = {step * i - 3: rng.standard_normal(5) for i in range(40)}
    ids = np.array(list(E_))
    vecs = spark.createDataFrame([(int(i), v.tolist()) for i, v in E_.items()] + [(1000, None)], "word_id long, vec array<double>").repartition(4)
    rows = [(int(rng.integers(0, 3)), *map(int, rng.choice(ids, 4))) for _ in range(3000)]
    lost = [(5, 99999, *map(int, ids[:3])), (6, None, *map(int, ids[:3])), (7, 1000, *map(int, ids[:3])), (8, -9, *map(int, ids[:3]))]
    win = spark.createDataFrame(rows + lost, "target long, c1 int, c2 int, c3 int, c4 int").repartition(3)
    args = (win, vecs, ["c1", "c2", "c3", "c4"], ["target"])
    monkeypatch.setattr(joins, "salted_join", lambda *a, **k: pytest.fail("shuffled"))
    want = sorted((r[0], *np.round(sum(E_[i] for i in r[1:]) / 4, 9)) for r in rows)
    assert 40 * 5 * 8 > 1500
    for limit in (1500, 700):  # two columns at a time, then one; many groups of windows
        made = TS.context_mean(*args, broadcast_bytes=limit, sliced_bytes=1 << 20)
        assert "hashpartitioning" not in made._jdf.queryExecution().executedPlan().toString()
        got = made.collect()
        assert sorted(r.target for r in got if r["mean"] is None) == [5, 6, 7, 8]
        assert sorted((r.target, *np.round(r["mean"], 9)) for r in got if r["mean"] is not None) == want
        short = TS.context_mean(*args, broadcast_bytes=limit, sliced_bytes=1 << 20, digest=True).collect()
        assert sorted(r.target for r in short if r.msum is None and r.mnorm is None) == [5, 6, 7, 8]
        assert np.allclose(sorted((r.target, r.msum, r.mnorm) for r in short if r.msum is not None),
                           sorted((w[0], sum(w[1:]), np.linalg.norm(w[1:])) for w in want), atol=1e-7)


def test_context_mean_slices_by_the_sessions_bounds(spark, monkeypatch):
    """The session's bound of all slices decides; beyond it the vectors are joined."""
    from vecspark.operators import joins
    vecs = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(100)], "word_id long, vec array<double>")
    win = spark.createDataFrame([(i, i, 99 - i) for i in range(100)], "k int, a int, b int")
    met, join = [], joins.salted_join
    monkeypatch.setattr(joins, "salted_join", lambda *a, **k: met.append(1) or join(*a, **k))
    spark.conf.set("vecspark.pythonBroadcastBytes", "2000")
    try:
        assert {tuple(r["mean"]) for r in TS.context_mean(win, vecs, ["a", "b"], ["k"]).collect()} == {(49.5, 1.0)} and not met
        spark.conf.set("vecspark.slicedBroadcastBytes", "2000")
        assert {tuple(r["mean"]) for r in TS.context_mean(win, vecs, ["a", "b"], ["k"]).collect()} == {(49.5, 1.0)} and met
    finally:
        spark.conf.unset("vecspark.pythonBroadcastBytes")
        spark.conf.unset("vecspark.slicedBroadcastBytes")
