"""Hard negatives against brute force, over many chunks, with ties, copies and rows that take no part."""

import math

import numpy as np
import pytest

from vecspark.llm import covertree


def brute(rows, every=100, scale=256, positives=5, negatives=10):
    fine = [(i, label, [math.floor(scale * x) for x in v]) for i, v, label in rows
            if label is not None and v and all(x is not None and math.isfinite(x) and abs(x * scale) <= 1 << 25 for x in v)]
    dims = [len(v) for _, _, v in fine]
    dim = max(set(dims), key=lambda d: (dims.count(d), -d)) if dims else 0
    fine = [r for r in fine if len(r[2]) == dim]
    last = lambda i: (i is None, i)
    out = []
    for a, (i, label, v) in enumerate(fine):
        if i is None or i % every:
            continue
        scores = [(sum(x * y for x, y in zip(v, w)), last(j), other) for b, (j, other, w) in enumerate(fine) if b != a]
        scores.sort(key=lambda s: (-s[0], s[1]))
        for ps, p, _ in [s for s in scores if s[2] == label][:positives]:
            hard = [s for s in scores if s[2] != label and 30 * ps <= 100 * s[0] <= 90 * ps][:negatives]
            out += [(i, p[1], k + 1, n[1], ps, ns) for k, (ns, n, _) in enumerate(hard)]
    return sorted(out, key=repr)


SCHEMA = "vec_id long, embedding array<double>, label int, uid string, v int, chunk int"


def got(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, covertree.hard_negatives(df, **more).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(4)
    centres = r.standard_normal((4, 6))
    vecs = [(centres[i % 4] + 0.5 * r.standard_normal(6)).round(1).tolist() for i in range(260)]
    vecs += [vecs[3]] * 90 + [[0.0] * 6] * 3 + [(5 * centres[0]).tolist()] * 2
    rows = [(i, v, int(r.integers(0, 3))) for i, v in enumerate(vecs)]
    rows += [rows[0], rows[0], (40, rows[7][1], 1), (None, vecs[0], 1), (None, vecs[2], 0), (500, None, 1), (520, [], 1), (540, vecs[1], None),
             (560, [float("nan")] + [1.0] * 5, 2), (580, [None] + [1.0] * 5, 2), (600, [float("inf")] * 6, 0), (620, [1.0], 0), (640, [1e300] * 6, 0)]
    return rows


def test_against_brute_force(spark, rows):
    assert got(spark, rows, every=20) == brute(rows, every=20)


def test_many_pivots_chunks_and_blocks(spark, rows, monkeypatch):
    for name, value in (("CHUNK", 16), ("LEAF", 3), ("FAN", 3), ("BLOCK", 4), ("PIVOTS", 9)):
        monkeypatch.setattr(covertree, name, value)
    assert got(spark, rows, every=20) == brute(rows, every=20)


def test_scores_beyond_doubles(spark):
    r = np.random.default_rng(5)
    rows = [(i, (1e5 + r.standard_normal(4) * 6e4).tolist(), i % 2) for i in range(60)]
    assert got(spark, rows, every=10) == brute(rows, every=10)


def test_edge_tables(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, None, 1), (100, [1.0], None)]) == []
    assert got(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []


def test_bounds_hold():
    r = np.random.default_rng(6)
    x = np.floor(256 * r.standard_normal((500, 8)))
    top = float((x ** 2).sum(axis=1).max())
    tree = covertree.Tree(x, np.arange(500), np.zeros(500, np.int64), top)
    assert sorted(tree.order.tolist()) == list(range(500))
    y = covertree._lift(x, top)
    for c, rad, a, z in zip(tree.centre, tree.radius, tree.start, tree.end):
        assert covertree._far(y[tree.order[a:z]], y[c]).max() <= rad
