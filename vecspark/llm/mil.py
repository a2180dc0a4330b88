"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``WORDS`` words, all of its text. A passage is described by shares of byte
classes, of repeated and of different words, mean word length, and hashed byte trigrams; a learned layer
encodes it as h. Gated attention, w . (tanh(V h) * sigmoid(U h)), is turned into weights by a softmax over
the document's passages, and the weighted sum of the h is scored by a logistic unit. All weights are learned
together from document labels alone.

The net is fitted on the driver on a bounded sample of labelled documents: at most ``sample`` different texts, in
order of a hash of the text, as far as ``sample_bytes`` reach (their passages' features are computed on the
executors). Scoring is one pass over all texts without a shuffle. A text is worked on in pieces of some
256 KB of whole passages, whose softmax states (largest logit, scaled sum, scaled weighted sum) are merged, so memory follows the
text alone.

Defined results: null, empty and blank texts are one passage without features. A word of more than
``LONG`` bytes counts as several. Rows are scored one by one, so repeated rows and equal texts get equal scores.
Labels other than 0 and 1, null labels and ids are not learned from; a text with several labels is learned with their mean. Without
any label to learn from every score is 0.5. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, utf8_values
from .words import word_bounds, word_names

#: Words of a passage, bytes of a word, bytes worked on at a time, hashed trigrams.
WORDS, LONG, PIECE, HASHED = 48, 1024, 1 << 18, 256
#: Byte classes: small letters, capitals, digits, blanks, line ends, sentence marks, each other ASCII mark, other characters.
_MARKS = b"!#$%&*|<>{}[]()=+_/\\@~^\"'`:"
_CLASS = np.zeros(256, np.int64)
for _i, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\v\f", b"\n", b".,;?-", *([c] for c in _MARKS),
                             range(128, 256)), start=1):
    _CLASS[list(_chars)] = _i
CLASSES = int(_CLASS.max()) + 1
FEATURES = CLASSES + 4 + HASHED


def pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of whole passages; empty for a text without words. Overlong words are cut by a blank."""
    if len(text) <= LONG:
        yield text
        return
    data = np.frombuffer(text, np.uint8)
    start, end = word_bounds(data)
    if (end - start > LONG).any():
        text = b" ".join(text[i:min(i + LONG, z)] for a, z in zip(start.tolist(), end.tolist()) for i in range(a, z, LONG))
        start, _ = word_bounds(np.frombuffer(text, np.uint8))
    cuts, at = start[WORDS::WORDS], 0
    while len(text) - at > PIECE:
        i = np.searchsorted(cuts, at + PIECE)
        if i >= len(cuts):
            break
        yield text[at:int(cuts[i])]
        at = int(cuts[i])
    yield text[at:]


def describe(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts (at least one each), and the first passage of each text. A text's
    features depend on nothing else."""
    texts = [t.strip() for t in texts]
    names = word_names(texts)
    size = np.array([len(n) for n in names], dtype=np.int64)
    name = np.concatenate(names) if names else np.zeros(0, np.uint64)
    count = np.maximum(1, -(-size // WORDS))
    first = np.cumsum(count) - count
    n = int(count.sum())
    x = np.zeros((n, FEATURES))
    if not len(name):
        return x, first
    held = [t for t in texts if t]
    data = np.frombuffer(b"  ".join(held) + b"  ", np.uint8)
    start, end = word_bounds(data)
    place = np.arange(len(name)) - np.repeat(np.cumsum(size) - size, size)  # of a word in its text
    of = np.repeat(first, size) + place // WORDS
    # a byte belongs to the passage of the last word that began, the two blanks between texts to none (n)
    opens = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    own, at = data, np.repeat(of[opens], np.diff(np.r_[start[opens], len(data)]))
    close = np.cumsum([len(t) + 2 for t in held])
    at[close - 1] = at[close - 2] = n
    total = np.maximum(np.bincount(at, minlength=n)[:n], 1)[:, None]
    x[:, :CLASSES] = np.bincount(at * CLASSES + _CLASS[own], minlength=n * CLASSES)[:n * CLASSES].reshape(n, CLASSES) / total
    many = np.maximum(np.bincount(of, minlength=n), 1)
    again = (name[1:] == name[:-1]) & (place[1:] > 0)
    x[:, CLASSES] = np.bincount(of[1:][again], minlength=n) / many
    pair = np.lexsort((name, of))
    new = np.r_[True, (name[pair][1:] != name[pair][:-1]) | (of[pair][1:] != of[pair][:-1])]
    x[:, CLASSES + 1] = np.bincount(of[pair][new], minlength=n) / many
    x[:, CLASSES + 2] = np.bincount(of, weights=(end - start) / 16, minlength=n) / many
    x[:, CLASSES + 3] = np.bincount(of, minlength=n) / WORDS
    wide = own.astype(np.int64)
    three = ((wide[:-2] * 65_599 + wide[1:-1]) * 65_599 + wide[2:]) * 2_654_435_761 >> 20 & (HASHED - 1)
    found = np.bincount(at[:-2] * HASHED + three, minlength=n * HASHED)[:n * HASHED].reshape(n, HASHED)
    x[:, CLASSES + 4:] = np.sqrt(found / total)
    return x, first


@dataclass
class Net:
    """``w``: encoder, ``v`` and ``u``: attention and its gate, ``a``: attention's weights, ``c``: the scorer. The last row of
    ``w`` and the last entry of ``c`` are constants' weights. ``mean`` and ``scale`` make features comparable."""
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    v: np.ndarray
    u: np.ndarray
    a: np.ndarray
    c: np.ndarray

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(h, attention, gate, logits) of passages."""
        h = np.tanh(((x - self.mean) / self.scale) @ self.w[:-1] + self.w[-1])
        t, g = np.tanh(h @ self.v), 1 / (1 + np.exp(-(h @ self.u)))
        return h, t, g, (t * g) @ self.a

    def score(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z @ self.c[:-1] + self.c[-1], -500, 500)))


def pool(h: np.ndarray, logit: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Softmax state of runs of passages that begin at ``first``: largest logit, scaled sum, scaled weighted sum."""
    most = np.maximum.reduceat(logit, first)
    e = np.exp(logit - np.repeat(most, np.diff(np.r_[first, len(logit)])))
    return most, np.add.reduceat(e, first), np.add.reduceat(e[:, None] * h, first, axis=0)


def fit(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = 40, batch: int = 64, rate: float = 0.004,
        decay: float = 1e-4, seed: int = 5) -> Net:
    """Weights by Adam on the cross-entropy of document labels (0 to 1)."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    small = lambda *s: rng.standard_normal(s) / np.sqrt(s[0])
    net = Net(every.mean(axis=0), every.std(axis=0) + 0.01, small(every.shape[1] + 1, hidden), small(hidden, gate), small(hidden, gate), small(gate),
              np.zeros(hidden + 1))
    names = "w", "v", "u", "a", "c"
    one, two = ({n: np.zeros_like(getattr(net, n)) for n in names} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), batch):
            own = [bags[j] for j in order[i:i + batch]]
            y = labels[order[i:i + batch]]
            size = np.array([len(b) for b in own])
            first, of = np.cumsum(size) - size, np.repeat(np.arange(len(own)), size)
            x = np.concatenate(own)
            h, t, g, logit = net.encode(x)
            most, total, z = pool(h, logit, first)
            alpha = np.exp(logit - most[of]) / total[of]
            z /= total[:, None]
            err = (net.score(z) - y) / len(own)
            dz = err[:, None] * net.c[:-1]
            gain = (h * dz[of]).sum(axis=1)
            dl = alpha * (gain - np.add.reduceat(alpha * gain, first)[of])
            dt, dg = dl[:, None] * net.a * g * (1 - t * t), dl[:, None] * net.a * t * g * (1 - g)
            dh = (alpha[:, None] * dz[of] + dt @ net.v.T + dg @ net.u.T) * (1 - h * h)
            scaled = (x - net.mean) / net.scale
            grad = {"w": np.r_[scaled.T @ dh, dh.sum(axis=0)[None]], "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ dl, "c": np.r_[z.T @ err, err.sum()]}
            step += 1
            for n in names:
                p = getattr(net, n)
                one[n] += 0.1 * (grad[n] - one[n])
                two[n] += 0.001 * (grad[n] ** 2 - two[n])
                p -= rate * (1 - epoch / epochs) * (one[n] / (1 - 0.9 ** step) / (np.sqrt(two[n] / (1 - 0.999 ** step)) + 1e-8) + decay * p)
    return net


def _features(batches):
    for b in small_batches(batches, 64):
        for i, text in enumerate(utf8_values(b.column("text"))):
            x = np.concatenate([describe([p])[0] for p in pieces(text)])
            yield pa.RecordBatch.from_arrays([b.column("name").slice(i, 1), pa.array([x.astype(np.float32).tobytes()], pa.binary())], names=["name", "x"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 4000,
          sample_bytes: int = 12_000_000) -> Net | None:
    """A net fitted to the labels of ``docs`` (joined by id), on at most ``sample`` different texts of together at most
    ``sample_bytes``, taken in order of the text's hash; None without a label. A text too long for what is left of the bytes is passed over."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
    named = docs.select(F.col(id_col).alias("id"), F.md5(text.cast("binary")).alias("name"), F.octet_length(text).alias("size"))
    merged = named.join(known, "id").groupBy("name").agg(F.avg("y").alias("y"), F.first("size").alias("size"), F.min("id").alias("id"))
    chosen, left = {}, sample_bytes
    for r in merged.orderBy("name").limit(sample).collect():
        if r["size"] <= left:
            chosen[r["name"]], left = r, left - r["size"]
    if not chosen:
        return None
    ids = docs.sparkSession.createDataFrame([(r["id"], r["name"]) for r in chosen.values()], ["id", "name"])
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text")).join(F.broadcast(ids.select("id").distinct()), "id", "left_semi")
    texts = texts.withColumn("name", F.md5(F.col("text").cast("binary"))).join(F.broadcast(ids), ["id", "name"], "left_semi")
    rows = texts.select("name", "text").mapInArrow(_features, "name string, x binary").collect()
    bags = {r["name"]: np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES).astype(np.float64) for r in rows}
    order = sorted(bags)
    return fit([bags[n] for n in order], np.array([chosen[n]["y"] for n in order]))


def _scorer(net: Net):
    def groups(texts: list[bytes]) -> Iterator[tuple[list[bytes], list[int]]]:
        held, of, size = [], [], 0
        for i, t in enumerate(texts):
            for p in pieces(t):
                if held and size + len(p) > PIECE:
                    yield held, of
                    held, of, size = [], [], 0
                held.append(p)
                of.append(i)
                size += len(p)
        if held:
            yield held, of

    def run(batches):
        for b in small_batches(batches):
            most, total = np.full(b.num_rows, -np.inf), np.zeros(b.num_rows)
            z = np.zeros((b.num_rows, net.w.shape[1]))
            for held, of in groups(utf8_values(b.column("text"))):
                x, first = describe(held)
                h, _, _, logit = net.encode(x)
                for i, m, s, v in zip(of, *pool(h, logit, first)):
                    top = max(most[i], m)
                    a, c = np.exp(most[i] - top), np.exp(m - top)
                    most[i], total[i], z[i] = top, total[i] * a + s * c, z[i] * a + v * c
            score = net.score(z / total[:, None])
            keep = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(score)], names=[*keep, "score"])
    return run


def score(docs: DataFrame, net: Net | None, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The columns ``keep``, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from ``threshold`` on)."""
    rows = docs.select(*keep, F.col(text_col).alias("text"))
    if net is None:
        out = rows.drop("text").withColumn("score", F.lit(0.5))
    else:
        kinds = dict(rows.dtypes)
        out = rows.mapInArrow(_scorer(net), ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
