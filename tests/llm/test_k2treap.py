"""Ranked search against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from vecspark.llm import k2treap

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(docs, items, k=50):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n, length = len(bags), sum(s for _, _, s in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        own = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in set(terms(text)) if t in df}
        scored = []
        for i, bag, size in bags:
            m = 100 - 50 + 50 * size * n // length
            s = sum(w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 20 * m)) for t, w in own.items())
            scored.append((-s, i is None, i)) if s > 0 else None
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables():
    r = np.random.default_rng(8)
    vocab = [f"w{i}" for i in range(120)] + ["Ünï", "漢字", "x9", "É"]
    p = 1 / np.arange(1, len(vocab) + 1)
    text = lambda n: " ".join(r.choice(vocab, n, p=p / p.sum()))
    docs = [(i, text(int(r.integers(1, 40)))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, " .,; \x00\x7f"), (303, "W1 w1_W1-w2"), (None, text(9)), (None, "w90 w91"), (5, text(9)), (5, docs[5][1])]
    docs += [(400 + i, "w3 w80 w81") for i in range(130)] + [(600, text(20_000)), (601, "w7" * 3000)]
    items = [(i, text(int(r.integers(1, 12)))) for i in range(12)]
    items += [(0, items[0][1]), (None, "w80 W80"), (20, None), (21, ""), (22, "notthere"), (23, "w80 w3 w81"), (24, "Ünï ünï É")]
    return docs, items


def got(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS rows", "3 AS uid").repartition(4)
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS item", "2 AS name", "3 AS score")
    return sorted(map(tuple, k2treap.rank(d, q, **more).collect()), key=repr)


def test_against_brute_force(spark, tables):
    assert got(spark, *tables) == brute(*tables)


def test_small_ranges_and_item_blocks(spark, tables, monkeypatch):
    for name, value in (("COLUMNS", 64), ("CELLS", 300), ("STEP", 2), ("ITEM_BYTES", 120)):
        monkeypatch.setattr(k2treap, name, value)
    assert got(spark, *tables, k=7) == brute(*tables, k=7)


def test_edge_tables(spark):
    assert got(spark, [], [(1, "a")]) == []
    assert got(spark, [(1, "a")], []) == []
    assert got(spark, [(1, None)], [(1, "a")]) == []


def test_tree_keeps_every_cell():
    r = np.random.default_rng(9)
    cells = {(int(a), int(b)): int(v) for a, b, v in zip(r.integers(0, 37, 500), r.integers(0, 300, 500), r.integers(1, 99, 500))}
    row, col = (np.array(c) for c in zip(*cells))
    tree = k2treap.Treap.unpack(k2treap.Treap.build(row, col, np.array(list(cells.values())), 37, 300).pack())
    for term in range(37):
        best = k2treap.Best(1000)
        k2treap.search(tree, np.arange(300), np.array([term]), best)
        assert dict(zip(best.id.tolist(), best.score.tolist())) == {b: v for (a, b), v in cells.items() if a == term}
