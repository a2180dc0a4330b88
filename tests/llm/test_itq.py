"""Vector links and components against brute force; recall at the threshold."""

import numpy as np

from vecspark.llm import itq


def brute(rows, cosine=0.95):
    ok = [v is not None and len(v) == 16 and None not in v and np.isfinite(np.array(v, float)).all() and any(v) for _, v in rows]
    n = len(rows)
    x = np.array([np.array(v, float) / np.linalg.norm(v) if o else np.zeros(16) for (_, v), o in zip(rows, ok)])
    near = x @ x.T >= cosine
    np.fill_diagonal(near, False)
    label = np.array([i for i, _ in rows])
    while True:
        low = np.array([min([label[i], *label[near[i]]]) for i in range(n)])
        if (low == label).all():
            break
        label = low
    return sorted((i, int(near[k].sum()), int(label[k]), i == label[k]) for k, (i, _) in enumerate(rows))


def test_against_brute_force(spark, monkeypatch):
    r = np.random.default_rng(3)
    vecs = []
    for size in (1, 1, 5, 60, 2, 200):
        base = r.standard_normal(16)
        vecs += [(base + 0.04 * r.standard_normal(16)).tolist() for _ in range(size)]
    vecs += [vecs[5], vecs[5], [2 * x for x in vecs[6]], r.standard_normal(16).tolist()]
    vecs += [None, [], [0.0] * 16, [None] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [1.0]]
    rows = list(zip(map(int, r.permutation(len(vecs))), vecs))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = brute(rows)
    assert sorted(map(tuple, itq.near_duplicates(df, misses=1e-6).collect())) == want
    monkeypatch.setattr(itq, "TILE", 40)  # crowded buckets in tiles
    assert sorted(map(tuple, itq.near_duplicates(df, misses=1e-6).collect())) == want


def test_recall_at_the_threshold():
    r = np.random.default_rng(5)
    x = r.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = r.standard_normal(x.shape)
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = 0.95 * x + np.sqrt(1 - 0.95 ** 2) * y
    t = itq.fit(x, 100_000)
    assert (t.keys(x) == t.keys(y)).any(axis=1).mean() > 0.97
    code = t.keys(x)
    assert abs((code >> 0 & 1).mean() - 0.5) < 0.05  # balanced bits


def test_recall_of_vectors_that_share_a_mean():
    r = np.random.default_rng(6)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    z = unit(r.standard_normal((20_000, 63)))
    u = r.standard_normal(z.shape)
    u = unit(u - (u * z).sum(axis=1, keepdims=True) * z)
    # mean of squared norm 0.8; the pairs' own parts are at 0.75, the whole at 0.95
    x, y = (np.c_[np.full(len(z), np.sqrt(0.8)), np.sqrt(0.2) * v] for v in (z, 0.75 * z + np.sqrt(1 - 0.75 ** 2) * u))
    assert np.allclose((x * y).sum(axis=1), 0.95)
    t = itq.fit(x, len(x))
    assert (t.keys(x[:4000]) == t.keys(y[:4000])).any(axis=1).mean() > 0.99


def test_edge_tables(spark):
    assert itq.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, node int")).collect() == []
    one = spark.createDataFrame([(5, [1.0, 2.0]), (4, [1.0, 2.0]), (None, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, itq.near_duplicates(one).collect()), key=repr) == [(4, 2, 4, True), (5, 2, 4, False), (None, 2, 4, False)]
