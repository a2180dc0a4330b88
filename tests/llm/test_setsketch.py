"""Near-duplicate components against brute force."""

import random

import numpy as np

from vecspark.llm import setsketch as S


def brute(docs, size=4, percent=80):
    def shingles(t):
        w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
        return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    sets = [shingles(t) for _, t in docs]
    comp = list(range(len(docs)))
    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                comp[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(sets[i]), least[root(i)], d == least[root(i)]) for i, (d, _) in enumerate(docs))


def edited(r, words, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"x{r.randrange(10 ** 6)}"
    return words


def test_against_brute_force(spark, monkeypatch):
    r = random.Random(4)
    texts = []
    for g in range(12):
        base = [f"w{r.randrange(5000)}" for _ in range(r.choice((3, 30, 120, 400)))]
        texts += [edited(r, base, r.choice((0, 1, 1, 2, 4)) * max(1, len(base) // 120)) for _ in range(r.choice((1, 3, 9, 40)))]
    # near-copies of near-copies: a chain
    chain = [f"c{i}" for i in range(200)]
    for _ in range(15):
        chain = edited(r, chain, 4)
        texts.append(chain)
    docs = [(d, r.choice((" ", "\n")).join(t)) for d, t in zip(r.sample(range(1000), len(texts)), texts)]
    docs += [(2000, docs[0][1].upper()), (2001, ""), (2002, None), (2003, " \t"), (2004, "a b"), (2005, "A  B"), (docs[1][0], docs[1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = brute(docs)
    assert sorted(map(tuple, S.near_duplicates(df, shingle=4).collect())) == want
    monkeypatch.setattr(S, "REST", (0.01, 0.01))  # more rounds of hubs before the rest is compared
    assert sorted(map(tuple, S.near_duplicates(df, shingle=4).collect())) == want


def test_registers_merge_and_estimate():
    r = np.random.default_rng(0)
    x = r.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2)
    a, b = x[:2000], x[400:]
    assert (S.merge(S.registers(a), S.registers(b)) == S.registers(x)).all()
    est = S.likely_jaccard(S.registers(a)[None], S.registers(b)[None], np.array([2000.0]), np.array([2600.0]))[0]
    assert abs(est - 1600 / 3000) < 0.2


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id long, text string, node binary")
    assert S.near_duplicates(df).collect() == []
    one = spark.createDataFrame([(None, "a b c d e f"), (None, None)], "doc_id long, text string")
    assert sorted(r.n_shingles for r in S.near_duplicates(one).collect()) == [0, 2]


def test_blocks_against_brute_force(spark, monkeypatch):
    r = random.Random(9)
    # a crowd of texts about as alike as the threshold, some pairs above it and some below
    base = [f"b{i}" for i in range(150)]
    texts = [edited(r, base, r.choice((1, 2, 3, 4))) for _ in range(60)]
    docs = [(d, " ".join(t)) for d, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(S, "CROWD", 0)      # every band left is compared in blocks
    monkeypatch.setattr(S, "REST", (1000, 1000))  # and no round of hubs goes before it
    want = brute(docs)
    assert sorted(map(tuple, S.near_duplicates(df, shingle=4).collect())) == want
    monkeypatch.setattr(S, "BLOCK_CLASSES", 7)  # many blocks a band
    assert sorted(map(tuple, S.near_duplicates(df, shingle=4).collect())) == want
    assert 1 < sum(kept for *_, kept in want) < len(docs)


def test_likely_and_common_agree_with_the_plain_forms():
    r = np.random.default_rng(1)
    pool = r.integers(0, 1 << 63, 400).astype(np.uint64) * np.uint64(2)
    sets = [np.unique(r.choice(pool, r.integers(250, 400), replace=False)) for _ in range(40)]
    n = np.array([len(s) for s in sets], float)
    regs = np.stack([S.registers(s) for s in sets])
    both = np.array([[len(np.intersect1d(a, b)) for b in sets[15:]] for a in sets[:15]])
    for width in (1, 64, 4096):
        assert (S.common(sets[:15], sets[15:], width) == both).all()
    est = np.array([S.likely_jaccard(np.repeat(x[None], 25, 0), regs[15:], np.full(25, m), n[15:]) for x, m in zip(regs[:15], n[:15])])
    for floor in (0.6, 0.65, 0.7):
        clear = np.abs(est - floor) > 0.006  # the plain form has a grid
        fits = np.minimum(n[:15, None], n[15:]) > floor * np.maximum(n[:15, None], n[15:])
        got = S.likely_at_least(regs[:15], regs[15:], n[:15], n[15:], floor)
        assert ((est >= floor) == got)[clear & fits].all() and 0 < got.sum() < got.size
