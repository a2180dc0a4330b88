"""Passages, attention and held-out accuracy of the quality classifier."""

import numpy as np

import __spark_entry__ as E
from vecspark.llm import mil


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = E.queries()["op13_quality"](spark, sf)
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert rows.count() == docs.count()
    assert rows.where("score is null or score < 0 or score > 1 or predicted <> int(score >= 0.3)").count() == 0
    known = rows.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    right = np.mean([r["predicted"] == r["quality"] for r in known])
    assert len(known) > 50 and right > 0.95


def test_attention_finds_the_passage_that_decides():
    r = np.random.default_rng(2)
    bags, labels = [], []
    for i in range(400):
        x = r.standard_normal((int(r.integers(1, 9)), 5))
        x[:, 0] = 0
        if i % 2:
            x[r.integers(0, len(x)), 0] = 3  # one passage makes the document
        bags.append(x)
        labels.append(i % 2)
    net = mil.fit(bags, np.array(labels, float))
    right = weight = 0
    for x, y in zip(bags, labels):
        h, _, _, logit = net.encode(x)
        most, total, z = mil.pool(h, logit, np.zeros(1, int))
        right += (net.score(z / total[:, None])[0] >= 0.5) == bool(y)
        if y:
            weight += int(logit.argmax() == x[:, 0].argmax())
    assert right / 400 > 0.97 and weight / 200 > 0.9


def test_gradients_are_those_of_the_loss():
    r = np.random.default_rng(3)
    bags, y = [r.standard_normal((n, 4)) for n in (1, 3, 5)], np.array([1.0, 0.0, 1.0])

    def loss(net):
        z = []
        for x in bags:
            h, _, _, logit = net.encode(x)
            _, total, s = mil.pool(h, logit, np.zeros(1, int))
            z.append((s / total[:, None])[0])
        p = net.score(np.array(z))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
    short, long = (mil.fit(bags, y, epochs=e, batch=3) for e in (1, 120))
    assert loss(long) < 0.25 * loss(short)


def test_pieces_and_passages():
    r = np.random.default_rng(1)
    text = b" \n".join(b"w%d" % i for i in r.integers(0, 99, 200_000)) + b" " + b"z" * 5000
    parts = list(mil.pieces(text))
    assert len(parts) > 2
    assert b" ".join(parts).split()[:200_000] == text.split()[:200_000]
    assert all(len(p.split()) % mil.WORDS == 0 for p in parts[:-1])
    whole = np.concatenate([mil.describe([p])[0] for p in parts])
    assert len(whole) == -(-(200_000 + 5) // mil.WORDS)
    x, first = mil.describe([b"", b"A b b c", b"  \t ", b"aa " * 100])
    assert first.tolist() == [0, 1, 2, 3] and len(x) == 6
    assert not x[0].any() and not x[2].any()
    assert x[1, mil.CLASSES] == 0.25 and x[1, mil.CLASSES + 1] == 0.75
    one = mil.describe([b"aa " * 100])[0]
    assert (x[3:] == one).all()
    assert (mil.describe([b"A b b c", b" ", b"z"])[0][0] == x[1]).all()


def test_defined_results(spark):
    docs = spark.createDataFrame([(1, "good words here", 1), (1, "good words here", 2), (2, None, 3), (None, "", 4), (3, "BAD!! " * 900, 5), (4, "x" * 300_000, 6)],
                                 "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (1, 1), (3, 0), (2, None), (None, 1), (4, 7)], "doc_id long, quality int")
    net = mil.train(docs, labels)
    got = {(r["doc_id"], i): r for i, r in enumerate(mil.score(docs, net).collect())}
    values = {k[0]: r["score"] for k, r in got.items()}
    assert len(got) == 6 and values[1] > 0.5 > values[3]
    assert values[2] == values[None]
    assert mil.train(docs, labels.limit(0)) is None
    assert {r["score"] for r in mil.score(docs, None).collect()} == {0.5}
    assert mil.score(docs.limit(0), net).collect() == []
    assert mil.train(docs, labels, sample_bytes=20) is not None
