"""Nearest-neighbour join and ranks against brute force: many cells, crowded cells, ties, nulls, zero vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecspark.operators import embed as E
from vecspark.operators import knn


@pytest.fixture(scope="module")
def tables():
    r = np.random.default_rng(11)
    centres = 4 * r.standard_normal((6, 5))
    vecs = [(m, i, (centres[i % 6] + r.standard_normal(5)).round(1).tolist()) for m in "ab" for i in range(150)]
    vecs += [("a", 1000 + i, vecs[4][2]) for i in range(60)] + [("a", 2000, [0.0] * 5), ("a", 2001, None), ("c", 5, [1.0, 2.0])]
    q = [(i, m, (centres[i % 6] + 2 * r.standard_normal(5)).round(1).tolist(), [i, i + 6]) for i, m in enumerate("ab" * 40)]
    q += [(500, "a", vecs[4][2], []), (501, "a", [0.0] * 5, None), (502, "a", None, None), (503, "nowhere", [1.0] * 5, None), (504, "c", [0.0, 0.0], [5])]
    return vecs, q


def frames(spark, tables):
    vecs, q = tables
    return (spark.createDataFrame(vecs, "model string, word_id long, vec array<double>").repartition(3),
            spark.createDataFrame(q, "qid int, model string, qvec array<double>, exclude array<long>").repartition(2))


def brute(tables, k, metric, use_exclude=True):
    vecs, queries = tables
    out = []
    for qid, m, q, ex in queries:
        rows = [(i, v) for mm, i, v in vecs if mm == m and v is not None and not (use_exclude and ex and i in ex)]
        if q is None or not rows:
            continue
        s = knn.scores(np.array([v for _, v in rows]), np.array(q), metric)
        top = sorted((-x if metric == "cosine" else x, i) for (i, _), x in zip(rows, s))[:k]
        out += [(qid, m, i, abs(x) if x == 0 else (-x if metric == "cosine" else x), n + 1) for n, (x, i) in enumerate(top)]
    return sorted(out)


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("cell", [4096, 9])
def test_join_equals_brute_force(spark, tables, monkeypatch, metric, cell):
    vecs, q = frames(spark, tables)
    monkeypatch.setattr(knn, "CELL", cell)
    monkeypatch.setattr(knn, "VISITORS", 7)
    got = sorted(map(tuple, knn.knn_join(vecs, q, 8, metric, "exclude").collect()))
    want = brute(tables, 8, metric)
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-12)


def test_scan_and_join_agree(spark, tables, monkeypatch):
    vecs, q = frames(spark, tables)
    few = sorted(map(tuple, E.similarity_scan(vecs, q, "euclidean", 5, "exclude").collect()))
    target = q.withColumn("target", F.when(F.col("qid") == 500, F.lit(1007)).otherwise(F.col("qid") % 150).cast("long"))
    ranks = sorted(map(tuple, E.rank_of(vecs, target).collect()))
    monkeypatch.setattr(E, "MAX_QUERY_BYTES", 0)
    monkeypatch.setattr(knn, "CELL", 16)
    assert sorted(map(tuple, E.similarity_scan(vecs, q, "euclidean", 5, "exclude").collect())) == few
    assert sorted(map(tuple, E.rank_of(vecs, target).collect())) == ranks
    for qid, m, t, dist, rank in ranks:
        v = [r for r in brute(tables, 10_000, "euclidean", use_exclude=False) if r[:2] == (qid, m)]
        assert next(r[4] for r in v if r[2] == t) == rank


def test_cells_prune(spark, tables):
    """Far cells are not visited."""
    r = np.random.default_rng(3)
    rows = [("m", i, (np.array([1000.0 * (i % 8), 0.0]) + r.standard_normal(2)).tolist()) for i in range(800)]
    vecs = spark.createDataFrame(rows, "model string, word_id long, vec array<double>")
    old, knn.CELL = knn.CELL, 100
    try:
        cells = knn.Cells(vecs, "euclidean")
        q = vecs.select(F.col("word_id").alias("qid"), "model", F.col("vec").alias("qvec"), F.lit(None).cast("array<long>").alias("exclude"))
        fields = "qid long, model string, qvec array<double>, exclude array<long>, cell int, near double, turn int"
        assert q.mapInArrow(knn._visits(cells.pivots, 5), fields).count() < 2 * 800
    finally:
        knn.CELL = old


def test_cosine_of_named_pairs(spark):
    vecs = spark.createDataFrame([("m", 1, [3.0, 4.0]), ("m", 2, [0.0, 0.0])], "model string, word_id long, vec array<double>")
    pairs = spark.createDataFrame([("m", 1, [6.0, 8.0]), ("m", 2, [1.0, 0.0]), ("m", 3, [1.0, 0.0])], "model string, word_id long, qvec array<double>")
    assert {r.word_id: r.sim for r in E.cosine_pairs(pairs, vecs).collect()} == {1: 1.0, 2: 0.0, 3: None}


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("group", [40 * 40, 40 * 500])
def test_join_and_ranks_over_many_groups(spark, tables, monkeypatch, metric, group):
    """Groups of some cells, cells over several groups, several shares of the queries."""
    vecs, q = frames(spark, tables)
    for name, value in (("CELL", 16), ("GROUP", group), ("STREAM", 40 * 10), ("TILE", 64), ("VISITORS", 5)):
        monkeypatch.setattr(knn, name, value)
    got, want = sorted(map(tuple, knn.knn_join(vecs, q, 8, metric, "exclude").collect())), brute(tables, 8, metric)
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    target = q.withColumn("target", F.when(F.col("qid") == 500, F.lit(1007)).otherwise(F.col("qid") % 150).cast("long"))
    ranks = knn.rank_join(vecs, target).collect()
    whole = {r[:3]: r[4] for r in brute(tables, 10_000, "euclidean", use_exclude=False)}
    assert len(ranks) == 82 and all(whole[r.qid, r.model, r.target] == r["rank"] for r in ranks)


def test_a_query_travels_once_to_a_group(spark):
    """What is moved grows with queries x groups, not with queries x cells: 20 cells of noise, which no distance rules out, are a few groups."""
    r = np.random.default_rng(5)
    vecs = spark.createDataFrame([("m", i, r.standard_normal(30).tolist()) for i in range(400)], "model string, word_id long, vec array<double>")
    old, knn.CELL = knn.CELL, 20
    try:
        cells = knn.Cells(vecs, "euclidean")
        q = vecs.select(F.col("word_id").alias("qid"), "model", F.col("vec").alias("qvec"), F.lit(None).cast("array<long>").alias("exclude"))
        fields = "qid long, model string, qvec array<double>, exclude array<long>, cell int, near double, turn int"
        assert q.mapInArrow(knn._visits(cells.pivots, 5), fields).count() > 10 * 400
        groups = cells.pivots.held["m"].shape[1]
        assert groups < 6 and q.mapInArrow(knn._visits(cells.pivots, 5, True), fields).count() == 400 * groups
    finally:
        knn.CELL = old


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_every_score_of_a_scan(spark, tables, monkeypatch, metric):
    vecs, q = frames(spark, tables)
    want = [w[:4] for w in brute(tables, 10_000, metric)]
    for limit in (E.MAX_QUERY_BYTES, 0):
        monkeypatch.setattr(E, "MAX_QUERY_BYTES", limit)
        got = sorted(map(tuple, E.similarity_scan(vecs, q, metric, None, "exclude").collect()))
        assert [g[:3] for g in got] == [w[:3] for w in want_by_id(want)]
        assert np.allclose([g[3] for g in got], [w[3] for w in want_by_id(want)], atol=1e-12)


def want_by_id(want):
    return sorted(want, key=lambda w: w[:3])


def test_cosine_pairs_scores_every_vector(spark):
    """Each of 27 predictions against all 500 vectors of its set."""
    from vecspark.plans import q_embed as Q
    got = Q.cosine_pairs(spark, "/root/testdata/sf0.001")
    assert got.columns == ["qid", "model", "word_id", "sim"] and got.count() == 27 * 500


def test_a_scan_works_in_bounded_pieces(spark):
    """Neither the formula's vectors nor the scan's matrices have as many rows as an Arrow batch."""
    sizes = spark.range(5000).coalesce(1)
    made = E.formula_vectors(sizes, "id", {"m": 8}).mapInArrow(lambda bs: bs, "model string, word_id long, vec array<double>")

    def rows(ids, X, p):
        assert len(X) <= 1024
        yield np.array([0]), np.array([len(X)], np.int64)
    out = E._scanned(made, {"m": {"qid": np.array([7])}}, rows, "qid long, model string, n long", lambda a, b: (a[0], a[1] + b[1])).collect()
    assert [tuple(r) for r in out] == [(7, "m", 5000)]


ODD = {"noise": lambda r: r.standard_normal((500, 20)), "far from the origin": lambda r: 1e6 + r.standard_normal((300, 8)), "tiny": lambda r: 1e-25 * r.standard_normal((300, 8)),
       "huge": lambda r: 1e25 * r.standard_normal((300, 8)), "all the same": lambda r: np.ones((300, 4)), "copies": lambda r: np.repeat(r.standard_normal((10, 6)), 30, axis=0),
       "closer than single precision": lambda r: 1 + 1e-9 * r.standard_normal((300, 8)), "ties": lambda r: r.integers(0, 3, (400, 4)).astype(float),
       "all sizes": lambda r: np.concatenate([10.0 ** e * r.standard_normal((100, 5)) for e in (-9, 0, 9)]), "zeros": lambda r: np.concatenate([np.zeros((50, 5)), r.standard_normal((100, 5))])}


class OneCell:
    """Pivots that rule nothing out."""

    def __init__(self, metric):
        self.metric = metric

    def sides(self, model, Q):
        none = np.zeros((len(Q), 1))
        return none, none, none + np.inf


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("kind", ODD)
def test_single_precision_only_chooses_candidates(monkeypatch, metric, kind):
    """Distances are single precision products of a bounded size with a bound of their error; the rows and ranks are those of double precision."""
    import pyarrow as pa
    monkeypatch.setattr(knn, "RUN", 64)
    monkeypatch.setattr(knn, "TILE", 64 * 16)
    monkeypatch.setattr(knn, "KEPT", 2)
    r = np.random.default_rng(6)
    X, k = ODD[kind](r), 7
    ids = 3 * r.permutation(len(X)).astype(np.int64)
    Q = np.concatenate([X[:30], 1.5 * X[-5:], 1000 * X[:2], np.zeros((1, X.shape[1])), np.full((1, X.shape[1]), 1e-30)])
    block = knn.Block.of([(ids[a:z], np.zeros(z - a, np.int64), X[a:z]) for a, z in ((0, 100), (100, len(X)))], X.shape[1], metric)
    assert block.low.dtype == np.float32 and sorted(block.ids) == sorted(ids)
    own, bound, scale, tiles = block.tiles(Q, np.ones((len(Q), len(block.runs)), bool))
    seen = 0
    for some, a, z, near in tiles:
        exact = ((knn.space(Q[some], metric, 1)[:, None] - knn.space(block.X[a:z], metric)[None]) ** 2).sum(axis=2) * scale ** 2
        assert z - a <= 64 and near.size <= 64 * 16 and (np.abs(near + own[some, None] - exact) <= bound[some, None]).all()
        seen += near.size
    assert seen == len(Q) * len(X)

    exclude = [[0, 3, 6], None, []] * len(Q)
    t = pa.table({"id": np.arange(len(Q)), "model": ["m"] * len(Q), "vec": list(Q), "exclude": pa.array(exclude[:len(Q)], pa.list_(pa.int64())), "limit": pa.nulls(len(Q), pa.float64())}).to_batches()[0]
    pivots = OneCell(metric)
    limited = next(iter(knn._limits(pivots, k)(block, t, Q))).column("limit")
    for limit in (t.column("limit"), limited):
        found = next(iter(knn._top(pivots, k)(block, t.set_column(4, "limit", limit), Q)))
        got = sorted(zip(found.column("qid").to_pylist(), found.column("score").to_numpy() * (-1 if metric == "cosine" else 1), found.column("word_id").to_pylist()))
        for q in range(len(Q)):
            stay = ~np.isin(ids, exclude[q] or [])
            s = knn.scores(X, Q[q], metric) * (-1 if metric == "cosine" else 1)
            assert [g[2] for g in got if g[0] == q] == list(ids[stay][np.lexsort((ids[stay], s[stay]))[:k]])
    if metric == "euclidean":
        target = r.integers(0, len(X), len(Q))
        dist = np.array([knn.scores(X[[j]], q, metric)[0] for j, q in zip(target, Q)])
        t = pa.table({"id": np.arange(len(Q)), "model": ["m"] * len(Q), "target": ids[target], "dist": dist, "sure": np.zeros(len(Q), np.int64)}).to_batches()[0]
        n = next(iter(knn._count_closer(pivots)(block, t, Q))).column("n").to_pylist()
        for q in range(len(Q)):
            s = knn.scores(X, Q[q], metric)
            assert n[q] == (((s < dist[q]) | ((s == dist[q]) & (ids < ids[target[q]]))) & (ids != ids[target[q]])).sum()


def test_the_longest_parts_come_first(spark):
    """A set of long vectors, most of the work, is not left to the last tasks."""
    r = np.random.default_rng(4)
    rows = [(m, i, r.standard_normal(d).tolist()) for m, d in (("a", 2), ("b", 40), ("c", 3)) for i in range(50)]
    cells = knn.Cells(spark.createDataFrame(rows, "model string, word_id long, vec array<double>"), "euclidean")
    dealt = cells.parts({m: 50 for m in "abc"}, True)
    assert [m for m, _, _ in dealt][0] == "b" and dealt[0][1] == 0
    starts = [0, *np.cumsum([shares * cells.pivots.held[m].shape[1] for m, _, shares in dealt])]
    assert [start for _, start, _ in dealt] == starts[:3]
