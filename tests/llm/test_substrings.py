"""Both substring operators against brute force, on random copies of passages and on edge cases."""

import hashlib
import random

import numpy as np
import pytest

from vecspark.llm import recompress, shared, suffixes


def brute(docs, n, units):
    """{row: covered units} for (id, text) rows by comparing every window with all documents."""
    least, cut = {}, [units(t or "") for _, t in docs]
    key = lambda d: shared.LAST if d is None else d
    for (d, _), u in zip(docs, cut):
        for i in range(len(u) - n + 1):
            w = tuple(u[i:i + n])
            least[w] = min(least.get(w, key(d)), key(d))
    out = []
    for (d, _), u in zip(docs, cut):
        mark = [False] * len(u)
        for i in range(len(u) - n + 1):
            if least[tuple(u[i:i + n])] < key(d):
                mark[i:i + n] = [True] * n
        out.append((u, mark))
    return out


def corpus(seed, vocab, runs):
    r = random.Random(seed)
    word = lambda: r.choice(vocab)
    texts = [[word() for _ in range(r.choice((0, 1, 5, 12, 13, 14, 40, 200)))] for _ in range(40)]
    passage = [word() for _ in range(30)]
    for t in texts[5:30]:
        at = r.randint(0, len(t))
        t[at:at] = passage[r.randint(0, 10):r.randint(14, 30)]
        if runs and r.random() < 0.5:
            t[r.randint(0, len(t)):0] = [word()] * r.randint(2, 30)
    texts += [list(t) for t in texts[10:20]]
    texts[-1] = ["same"] * 100
    texts[-2] = ["same"] * 57 + ["x"] + ["same"] * 30
    ids = r.sample(range(-50, 500), len(texts))
    rows = [(i, r.choice((" ", "\n", "  ")).join(t)) for i, t in zip(ids, texts)]
    return rows + [(ids[0], rows[1][1]), (ids[3], rows[3][1]), (None, rows[20][1]), (777, None), (778, "")]


@pytest.mark.parametrize("seed, vocab, runs", [(1, [f"w{i}" for i in range(300)], False), (2, ["a", "b"], True),
                                               (3, ["ä", "b", "cc", "ddd"], True), (4, [f"w{i}" for i in range(30)], True)])
def test_words(spark, monkeypatch, seed, vocab, runs):
    docs = corpus(seed, vocab, runs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = recompress.dedup(df).collect()
    want = brute(docs, 13, str.split)
    assert sorted((repr(g.doc_id), g.n_words, g.n_removed, g.kept_text) for g in got) == sorted(
        (repr(d), len(u), sum(m), " ".join(w for w, x in zip(u, m) if not x)) for (d, _), (u, m) in zip(docs, want))
    assert all(hashlib.sha256(g.kept_text.encode()).hexdigest() == g.kept_sha256 for g in got)


@pytest.mark.parametrize("seed, vocab", [(5, [f"word{i}" for i in range(300)]), (6, ["a", "b"]), (7, ["é", "ab", "x" * 60])])
def test_bytes(spark, seed, vocab):
    docs = corpus(seed, vocab, True)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = suffixes.dedup(df).collect()
    want = brute(docs, 50, str.encode)
    assert sorted((repr(g.doc_id), g.n_bytes, g.n_removed, bytes(g.kept), g.n_spans) for g in got) == sorted(
        (repr(d), len(u), sum(m), bytes(b for b, x in zip(u, m) if not x), sum(1 for i, x in enumerate(m) if x and not (i and m[i - 1])))
        for (d, _), (u, m) in zip(docs, want))


def test_long_texts_go_through_in_blocks(monkeypatch):
    r = np.random.default_rng(0)
    m = suffixes._method(50)
    units = [r.integers(0, 4, n).astype(np.uint8) for n in (10, 49, 50, 51, 1000, 3)]
    seen = []
    for b in shared.blocks(units, 50, size=64):
        for w in b.windows(50):
            j = b.piece(np.array([w]))[0]
            seen.append((int(b.row[j]), int(w - b.start[j] + b.offset[j])))
            assert (b.units[w:w + 50] == units[b.row[j]][seen[-1][1]:][:50]).all()
    assert sorted(seen) == [(i, w) for i, u in enumerate(units) for w in range(len(u) - 49)]
    assert m.window == 50


def test_messages_round_trip():
    r = np.random.default_rng(1)
    for n in (0, 1, 1000):
        a = np.sort(r.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        assert (shared.unpack(shared.pack(a)) == a).all() and (shared.unplain(shared.plain(a)) == a).all()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, part int, names binary, kept string")
    assert recompress.dedup(df).collect() == [] and suffixes.dedup(df).collect() == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a " * 60, 3, "x"), (2, "a " * 60, 4, "y")], "doc_id long, text string, part int, h1 string")
    assert {r.doc_id: r.n_removed for r in recompress.dedup(df).collect()} == {1: 0, 2: 60}
